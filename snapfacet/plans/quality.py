"""Records that cannot be processed: set aside with their reason, counted while the others are written.

The strict transform fails a run at its first bad number or date. With ``quarantine`` a run takes the good records, and the bad ones go to a
side table ``quarantine/snapshot=<key>/`` as they came, with the reasons. How many there are of either kind, per
snapshot, is observed while the good ones are written (``DataFrame.observe``): no count reads the raw files, or what was
written, again. Only where bad records were seen are the files read once more, to set them aside.

A record is bad if it is not JSON, or if a column that the transform casts strictly does not cast. Null columns are
good: the transform keeps them null. Records of a snapshot that are all bad leave it without a processed folder, so the
gate takes it up again when it is landed anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import casts
from ..sources.snapshots import CORRUPT_COL, SNAPSHOT

#: Column -> the lenient form of its strict cast in the transform.
STRICT = {
    "salary_range_from": casts.to_double,
    "salary_range_to": casts.to_double,
    "posting_date": casts.timestamp_text_to_date,
    "post_until": casts.parse_dmy,
    "posting_updated": casts.timestamp_text_to_date,
    "process_date": casts.timestamp_text_to_date,
}
#: Snapshots that one run counts apart.
MOST = 200


def reasons(df: DataFrame) -> Column:
    """Why a raw record is bad: 'json', and the names of the columns that do not cast. Empty: it is good."""
    tests = [(c, F.col(c).isNotNull() & cast(c, True).isNull()) for c, cast in STRICT.items() if c in df.columns]
    if CORRUPT_COL in df.columns:
        tests.insert(0, ("json", F.col(CORRUPT_COL).isNotNull()))
    return F.filter(F.array(*(F.when(test, F.lit(name)) for name, test in tests)), lambda r: r.isNotNull())


class Counted:
    """Good and bad records of each snapshot, observed while the frame ``good`` is written."""

    def __init__(self, raw: DataFrame, keys: list[str], key: str = SNAPSHOT):
        if len(keys) > MOST:
            raise ValueError(f"at most {MOST} snapshots are counted in one run")
        self.keys, self.observation = list(keys), Observation()
        checked = raw.withColumn("_reasons", reasons(raw))
        bad = F.size("_reasons") > 0
        of = lambda k, test: F.count(F.when((F.col(key).cast("string") == F.lit(k)) & test, 1))
        counts = [of(k, test).alias(f"{name}{i}") for i, k in enumerate(self.keys) for name, test in (("good", ~bad), ("bad", bad))]
        seen = checked.observe(self.observation, F.count(F.lit(1)).alias("all"), *counts)
        self.good = seen.where(~bad).drop("_reasons", CORRUPT_COL)
        self.bad = checked.where(bad).withColumnRenamed("_reasons", "reasons")

    def counts(self) -> dict[str, tuple[int, int]]:
        """(good, bad) of each snapshot; there after the good ones were written."""
        got = self.observation.get
        return {k: (got[f"good{i}"], got[f"bad{i}"]) for i, k in enumerate(self.keys)}


def write_quarantine(bad: DataFrame, root: str, key: str = SNAPSHOT) -> None:
    """The side table: bad records as they came, with ``reasons``; a snapshot processed again replaces its own."""
    bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).json(f"{root}/quarantine")


def read_quarantine(spark, root: str, schema=None) -> DataFrame:
    from ..schema import RAW

    text = ", ".join(f"`{f.name}` string" for f in RAW.fields)
    return spark.read.schema(schema or f"{text}, `{CORRUPT_COL}` string, reasons array<string>, {SNAPSHOT} string").json(f"{root}/quarantine")
