"""Steps of the credit job, each ``DataFrame -> DataFrame``."""
