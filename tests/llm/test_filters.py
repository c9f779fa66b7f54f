"""Quality rules, toxicity, URL filter and the pipeline."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import prose

import corpus_pipeline
from credmill.llm import minhash, packing, quality, registry, suffixes, toxicity, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for at in range(len(words) - 2):
        if windows[tuple(words[at : at + 3])] > 1:
            covered |= {at, at + 1, at + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_rules(odd, odd_rows):
    found = quality.judge(odd).collect()
    expected = sorted(str((i, *base_brute(t))) for i, t in odd_rows)
    assert sorted(str(tuple(r)[:7]) for r in found) == expected
    assert not any(r.kept and r.base_failed for r in found)


def test_divergent_documents_go_and_clean_ones_stay(spark):
    rng = random.Random(1)
    common = ["the", "of", "and", "to", "in", "is"]
    clean = lambda: " ".join(rng.choice(common) if rng.random() < 0.5 else f"word{chr(97 + rng.randrange(26))}" for _ in range(120))
    rows = [(i, clean(), "en") for i in range(80)]
    rows.append((100, " ".join(w + "###" for w in clean().split()), "en"))
    rows.append((101, clean().upper(), "en"))
    rows.append((102, " | ".join(f"item{i}" for i in range(120)), "en"))
    rows.append((103, clean(), None))
    rows.append((104, clean(), "xx"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {*range(80), 103, 104}


def test_rare_languages_have_their_own_reference_or_none(spark, monkeypatch):
    monkeypatch.setattr(quality, "HELD_WORDS", 300)  # counts go on in parts
    rng = random.Random(2)
    text = lambda words, n, kinds=30: " ".join(f"{rng.choice(words)}{rng.randrange(kinds)}" for _ in range(n))
    rows = [(i, text(["the", "of", "and"], 60, 8), "en") for i in range(2100)]
    rows += [(3000, text(["это", "как", "для"], 80), "ru"), (3001, "это " * 80, "ru")]  # too few for a reference
    rows += [(4000, text(["και", "του", "της"], 2500), "el"), (4001, text(["the", "of"], 80), "el")]
    rows += [(5000, text(["это", "как", "для"], 80), None), (5001, text(["the", "of", "and"], 60, 8), "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = quality.references(docs)
    assert set(known) == {"en", "el"}
    counted = Counter(w for r in rows if r[2] == "en" for w in r[1].split())
    top = sorted((n for n in counted.values()), reverse=True)[: quality.COMMON_WORDS]
    assert np.allclose(sorted(known["en"].shares[:-1]), sorted(n / counted.total() for n in top))
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {*range(2100), 3000, 4000, 5001}


def test_quality_of_nothing(documents):
    empty = documents((1, "a")).filter("false")
    assert quality.judge(empty).count() == 0
    assert quality.keep_good(empty).columns == empty.columns


def edits(word):
    letters = "abcdefghijklmnopqrstuvwxyz"
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    yield from (a + b[1:] for a, b in cuts if b)
    yield from (a + c + b[1:] for a, b in cuts if b for c in letters)
    yield from (a + c + b for a, b in cuts for c in letters)


def test_automaton_finds_all_words_at_one_error():
    lexicon = toxicity.Lexicon({"idiot": 2.0, "worthless": 3.0, "bad": 1.0}, {"vequ": 4.0})
    for term, weight in (("idiot", 2.0), ("worthless", 3.0)):
        for word in edits(term):
            assert lexicon.look_up(word) == ((weight, False) if word == term else (weight, True)), word
    assert lexicon.look_up("bad") == (1.0, False)
    assert lexicon.look_up("bax") is None
    assert lexicon.look_up("vequoir") == (4.0, False)
    assert lexicon.look_up("idxxot") is None


def test_quoted_hits_count_apart():
    memo = toxicity._Memo(toxicity.Lexicon({"idiot": 2.0}, {}))
    plain = toxicity.features("you are an idiot and more", memo)
    quoted = toxicity.features('she was called an "idiot" by him', memo)
    assert plain[0] > 0 and plain[1] == 0 and plain[3] > 0
    assert quoted[0] == 0 and quoted[1] > 0
    assert toxicity.features("", memo) == (0.0,) * len(toxicity.FEATURES)


def toxic_tables(spark, n=400):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["idiot", "moron,", "scumbag", "idiott"])
        docs.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(toxic)))
    docs += [(n, None, "en"), (n + 1, "", "en"), (None, "you idiot", "en")]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_toxicity(spark):
    docs, labels = toxic_tables(spark)
    rows = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == 403
    for row in rows:
        held = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2
        assert row.held_out == held
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    wrong = sum(r.predicted != truth[r.doc_id] for r in held)
    assert wrong <= 0.05 * len(held)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns


def test_misspellings_of_terms_with_variants(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(300)}" for _ in range(30)]
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(["idiot", "idiots", "idiott", f"{rng.choice('bcfghjkmnpqrtvxz')}diot", "moron"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    wrong = ["idkot", "diot", "iidiot", "odiot", "ldiots"]
    docs += [(1000 + i, f"w1 w2 {word} w3 w4") for i, word in enumerate(wrong)] + [(2000, "w1 w2 w5 w3 w4")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any("idiot".startswith(stem) for stem in model.lexicon.stems)
    for word in wrong:
        assert model.lexicon.look_up(word) is not None, word
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).filter("doc_id >= 1000").collect()}
    assert all(scores[1000 + i] > scores[2000] for i in range(len(wrong))), scores


def test_lexicon_has_the_long_tail(spark):
    letters = "bcdfghjklmnpqrstvwxz"
    common = [f"{a}{b}{c}uuuuuu" for a in letters for b in letters for c in letters[:2]]  # 800 terms in 8 documents each
    rows = [(f"w{i % 97} {' '.join(common[(i + k) % 800] for k in range(4))}", 1) for i in range(1600)]
    rows += [(f"w{i % 97} rareslur", 1) for i in range(8)]  # half a percent of toxic documents
    rows += [(f"w{i % 97} w{i % 89}", 0) for i in range(16000)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert lexicon.look_up("rareslur") is not None and lexicon.look_up("rareslvr") is not None
    assert all(lexicon.look_up(term) is not None for term in common)
    assert all(lexicon.look_up(f"w{i}") is None for i in range(97))


def test_held_out_labels_are_not_read(spark):
    docs, labels = toxic_tables(spark)
    flipped = labels.selectExpr(
        "doc_id", "quality", "if(crc32(cast(doc_id AS string)) % 4 = 2, 1 - toxic, toxic) AS toxic"
    )
    a = toxicity.train(docs, labels)
    b = toxicity.train(docs, flipped)
    assert a.lexicon.stems == b.lexicon.stems and np.allclose(a.weights, b.weights)


def test_toxicity_without_labels(spark):
    docs, labels = toxic_tables(spark, 20)
    scores = toxicity.score(docs, toxicity.train(docs, labels.filter("false"))).collect()
    assert {r.score for r in scores} == {0.0}
    assert toxicity.score(docs.filter("false"), toxicity.train(docs.filter("false"), labels)).count() == 0


URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.net/en/x", "https://example.net", "http://a.b.net/y",
    "http://net/", "http://xnet/", "http://internet", "http://example.com/de/1", "http://Sub.Example.COM/de/1",
    "http://example.com/dex", "http://example.org/fr/1?a=1", "http://org/fr/", "http://a.org/frx#/fr/",
    "http://spam-farm.org/1/?utm_source=x&b=2&a=1#t", "https://www.spam-farm.org:443/1?a=1&b=2",
    "ftp://spam-farm.example.org?x", "http://h.org://x/fr/", "http://a.example.net/en/",
]


def test_urls_against_sql(spark, tmp_path):
    rows = [(i, u, "x") for i, u in enumerate(URLS * 2)] + [(None, "http://a.net/", "x")]
    (tmp_path / "sf").mkdir()
    path = f"{tmp_path}/sf/pages.parquet"
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(path)
    found = urls.query(spark, f"{tmp_path}/sf").collect()
    tables = duckdb.connect()
    tables.sql(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    expected = tables.sql(urls.ORACLE_SQL).fetchall()
    assert sorted(str(tuple(r)) for r in found) == sorted(map(str, expected))
    verdicts = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    assert verdicts[0] == ("", "", None, "allow")
    assert verdicts[4] == ("example.net", "/en/x", "example.net/en/", "allow")
    assert verdicts[5] == ("example.net", "", None, "allow")
    assert verdicts[16] == ("spam-farm.org", "/1/", None, "block")


def test_bloom_filter_lets_all_listed_pass_and_the_join_removes_the_rest(spark, monkeypatch):
    monkeypatch.setattr(urls.bloom, "MAX_BLOCKS", 1)  # every block is full
    listed = spark.createDataFrame([(f"h{i}.org/",) for i in range(2000)], "canonical string")
    pages = spark.createDataFrame([(i, f"http://h{i}.org/x") for i in range(50)], "page_id long, url string")
    assert {r.verdict for r in urls.judge(pages, listed).collect()} == {"allow"}
    listed = spark.createDataFrame([(f"h{i}.org/x",) for i in range(0, 50, 2)], "canonical string")
    blocked = {r.page_id for r in urls.judge(pages, listed).collect() if r.verdict == "block"}
    assert blocked == set(range(0, 50, 2))
    assert urls.judge(pages, listed.filter("false")).filter("verdict = 'block'").count() == 0
    assert urls.judge(pages.filter("false"), listed).count() == 0


def plain_rule(host, path, rules):
    """The rule that decides, and its verdict."""
    fits = [
        r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if not fits:
        return None, None
    best = min(fits, key=lambda r: (-len(r.text), -len(r.host), r.text, r.verdict != "block"))
    return best.text, best.verdict


def test_any_number_of_rules(spark, monkeypatch):
    rng = random.Random(2)
    hosts = ["net", "a.net", "b.a.net", "org", "x.org", "com", "h.com", "", "..net", "xnet"]
    rules = {
        urls.Rule(rng.choice(["block", "allow"]), rng.choice(hosts[:8]), "/" + "".join(rng.choices("ab/", k=rng.randint(0, 4))))
        for _ in range(150)
    } | {urls.Rule("allow", "org", ""), urls.Rule("block", "org", ""), urls.Rule("allow", "h.com", "/a")}
    rules = tuple(sorted(rules, key=lambda r: rng.random()))
    pages = [(i, f"http://{rng.choice(hosts)}/{''.join(rng.choices('ab/', k=rng.randint(0, 5)))}") for i in range(400)]
    pages += [(None, None), (1, "nothing"), (2, "http://org")]
    frame = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'x' AS rule", "'x' AS n", "'x' AS best")
    none = spark.createDataFrame([], "canonical string")
    few = sorted(str(tuple(r)) for r in urls.judge(frame, none, rules=rules).collect())
    monkeypatch.setattr(urls, "INLINE_RULES", 10)
    many = urls.judge(frame, none, rules=rules).collect()
    assert sorted(str(tuple(r)) for r in many) == few and len(few) == len(pages)
    for row in many:
        rule, verdict = plain_rule(row.host, row.path, rules)
        assert (row.rule, row.verdict) == (rule, verdict or "allow")
    table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    assert sorted(str(tuple(r)) for r in urls.judge(frame, none, rules=table).collect()) == few
    assert urls.judge(frame.filter("false"), none, rules=table).count() == 0
    assert {r.rule for r in urls.judge(frame, none, rules=table.filter("false")).collect()} == {None}


def test_weights_come_from_one_part_only(spark):
    docs, labels = toxic_tables(spark, 200)
    part = toxicity.train_part(F.col("doc_id"))
    assert toxicity.train(docs, labels).weights is not None
    assert toxicity.train(docs, labels.filter(part != 3)).weights is None


def test_pipeline_against_its_stages_one_by_one(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "near_duplicates", "repeated_substrings", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    good = docs.filter(docs.doc_id.isin(list(judged)))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.score(good, toxicity.train(good, labels)).collect() if r.predicted}
    clean = good.filter(~good.doc_id.isin(list(toxic)))
    firsts = {r.doc_id for r in minhash.near_duplicates(clean).collect() if r.kept}
    cut = suffixes.without_repeats(clean.filter(clean.doc_id.isin(list(firsts))))
    import public_tokenizers

    expected = packing.pack(cut, tokenizer=public_tokenizers.path("byte_bpe_50k.json"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, rows.select(columns).collect())) == sorted(map(tuple, expected.select(columns).collect()))
    ends = {}
    for row in sorted(rows.collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == ends.get(row.sequence_id, 0)
        assert row.length == len(row.ids)
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
        ends[row.sequence_id] = row.offset + row.length
    assert max(ends.values()) <= 1024


def test_stages_take_odd_rows(spark, odd, sf_dir):
    labels = f"{sf_dir}"
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.filter("false")):
            found = stage(spark, rows, labels)
            assert name == "packing" or found.columns == rows.columns
            found.count()


def test_registry(spark):
    names = registry.queries()
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in names) == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(names)
    assert prose(random.Random(1), 3)
