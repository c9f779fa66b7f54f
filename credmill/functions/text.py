"""Text and date parsing as native Spark SQL expressions.

All parsers are tolerant: what does not parse becomes NULL, whatever the ANSI
setting of the session.
"""

from __future__ import annotations

# Cased letters are the ones with a lower, upper or title form.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_WORD_START = f"(?<=[^{_CASED}])(?=[{_CASED}])"
# A Unicode noncharacter, so it does not occur in text, and the blank that
# makes initcap start a word.
_BREAK = "\ufdd0 "


def title_case(text: str) -> str:
    """Upper-case every letter that follows a non-letter, lower-case the rest.

    ``debt_consolidation`` gives ``Debt_Consolidation`` and ``o'neil`` gives
    ``O'Neil``.  Empty text gives NULL.  Plain ``initcap`` starts words at
    blanks only, hence the breaks put in before it and taken out after it.
    The calls stay inside generated code.
    """
    marked = f"regexp_replace(nullif({text}, ''), r'{_WORD_START}', '{_BREAK}')"
    return f"replace(initcap({marked}), '{_BREAK}', '')"


def digits(text: str) -> str:
    """Keep the digits only; text without any gives the empty string."""
    return f"regexp_replace({text}, '[^0-9]', '')"


def digits_and_dots(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9.]', '')"


def whole_number(text: str) -> str:
    """``' 36 months'`` gives 36."""
    return f"try_cast({digits(text)} AS int)"


def percentage(text: str, kind: str = "double") -> str:
    """``'13.56%'`` gives 13.56; two dots do not parse."""
    return f"try_cast({digits_and_dots(text)} AS {kind})"


def month_date(text: str, pattern: str) -> str:
    """The first day of the month that ``text`` names."""
    return f"try_to_date({text}, '{pattern}')"
