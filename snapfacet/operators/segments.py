"""Text index kept across snapshots: X1 / E2 without tokenising what is already known.

The index is made of immutable segments, one for each snapshot that brought new content. A row's
content is known by its ``content_id`` (the row hash without the snapshot's date), so a posting that is in
the index already, under whatever snapshot, is not read again. What a snapshot no longer has goes on a
list of tombstones; content that comes back leaves the list. The live index is the segments without the tombstones:

* corpus size and average length are sums over the segments less a sum over the tombstones;
* a term's document frequency is counted over its live postings, which a search reads anyway.

So scores equal those of an index built at once from the newest snapshot. ``merge`` writes segments
together as one without their tombstones, from the stored postings; no text is needed for it.

Adding a snapshot reads its ids, the ids of the index, and the texts of the new contents once: these are tokenised into one
row per document, and lengths and postings come from those rows. Whole texts go through a shuffle only to be told from known
contents or where new content ids come more than once.

A document has a number, fixed when its counts are staged, and postings hold that number, not the content id. The tombstones are
kept as a bit per document too, 64 numbers a row: postings lose their dead documents by a look-up in these (10 million
documents: 156,250 rows), in place, not by a join that moves all postings. Ids are joined to the postings a search has found.

A new segment is a file for each run of its documents, some two million postings sorted by (term, number): nothing is
shuffled for it, and a query's terms are read from the row groups of each file that cover them. ``merge`` writes postings
range-partitioned and sorted by (term, number) over all files, so that a query's terms are read from few row groups, and a term
that a third of all documents hold is spread over many files.

Everything a snapshot changes is published by one record (``sources.versions``): readers see the index before or after, and
a job that dies leaves it as it was; run again it does the whole step anew.

Defined results: rows with one content id are one document; rows with a null content id take no part; a snapshot that was
added before changes nothing; an empty snapshot makes every document a tombstone.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_conf, scratch
from ..sources import versions as V
from .text_index import ROWS_PER_FILE, TextIndex, counted_documents, exploded_counts

DOCS, POSTINGS, TOMBSTONES, BITS = "docs", "postings", "tombstones", "bits"
#: Staged counts that one task makes postings of: some two million postings. A row group is a part of that, as files are cut between groups.
STAGED_BYTES, STAGED_GROUP = 16 << 20, 8 << 20
#: Rows of bits (64 documents each) that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Change:
    """What adding a snapshot has done: documents tokenised, come back, and gone."""

    segment: str | None
    added: int
    revived: int
    gone: int


class SegmentedIndex:
    """An index under ``path``; ``columns``, stop words and stemmer hold for all of its segments."""

    def __init__(
        self, spark: SparkSession, path: str, columns: Sequence[str], id_col: str = "content_id", stop_words: Sequence[str] = (), stemmer: bool = False
    ):
        self.spark, self.path, self.columns, self.id_col = spark, path.rstrip("/"), tuple(columns), id_col
        self.stop_words, self.stemmer = tuple(stop_words or ()), stemmer
        self.settings = {"id": id_col, "columns": list(columns), "stop_words": sorted(self.stop_words), "stemmer": stemmer, "layout": "numbered"}

    # -- what is published: folders by (kind, segment), and a note with the segments' sums

    def _current(self) -> tuple[V.Version | None, dict]:
        version = V.current(self.spark, self.path)
        note = json.loads(version.note) if version else {"settings": self.settings, "segments": {}, "tombstones": [0, 0, 0], "next": 0, "last": None}
        if note["settings"] != self.settings:
            raise ValueError(f"{self.path} was built with other settings: {note['settings']}")
        return version, note

    def _folders(self, version: V.Version | None, kind: str) -> list[str]:
        return [f"{self.path}/{f}" for k, f in (version.folders if version else ()) if k.partition("/")[0] == kind]

    def _read(self, version: V.Version | None, kind: str, schema) -> DataFrame:
        folders = self._folders(version, kind)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _schema(self, kind: str, id_type: str) -> str:
        return {POSTINGS: "term string, num long, tf long, dl long", BITS: "word long, bits long"}.get(kind, f"`{self.id_col}` {id_type}, num long, dl long")

    def _store(self, df: DataFrame, name: str) -> tuple[str, str]:
        _, ((_, folder),) = V.write(self.spark, self.path, df)
        return name, folder

    def segments(self) -> dict[str, dict]:
        """The segments with their documents (``n``) and tokens (``dl``)."""
        return self._current()[1]["segments"]

    # -- adding a snapshot

    def add_snapshot(self, rows: DataFrame, name: str) -> Change:
        """Bring the index to the contents of ``rows`` (the whole snapshot ``name``)."""
        version, note = self._current()
        id_type = rows.schema[self.id_col].dataType.simpleString()
        key = self.id_col
        rows = rows.where(F.col(key).isNotNull())
        known = self._read(version, DOCS, self._schema(DOCS, id_type))
        dead = self._read(version, TOMBSTONES, self._schema(TOMBSTONES, id_type))
        listed = scratch(self.spark, "ids")
        rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).write.parquet(listed)
        ids = self.spark.read.parquet(listed)
        new, fresh = ids.join(known.select(key), key, "left_anti"), rows
        if self._folders(version, DOCS):
            fresh = rows.join(new.select(key), key, "left_semi")
        if new.where("n > 1").limit(1).count():
            fresh = fresh.dropDuplicates([key])
        # the only place where texts are read; lengths and postings come from what is staged here
        staged = scratch(self.spark, "counted")
        counted = counted_documents(fresh, key, self.columns, self.stop_words).withColumn("num", F.monotonically_increasing_id() + F.lit(note["next"]))
        counted.write.option("parquet.block.size", STAGED_GROUP).parquet(staged)
        counted = self._in_small_tasks().read.parquet(staged)
        added = counted.agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("dl"), F.coalesce(F.sum(F.size("c")), F.lit(0)).alias("p"), F.max("num").alias("last")
        ).first()
        folders, tombstones = self._store_dead(known.join(ids, key, "left_anti"))
        segment = None
        if added["n"]:
            segment = f"{len(note['segments']) + 1:06d}-{name}"
            while segment in note["segments"]:  # after a merge numbers may come again
                segment += "+"
            folders.append(self._store(counted.select(key, "num", "dl"), f"{DOCS}/{segment}"))
            postings = exploded_counts(counted, "num", self.stemmer)
            # stemming has dealt the postings by stem
            postings = self._sorted(postings, added["p"]) if self.stemmer else postings.sortWithinPartitions("term", "num")
            folders.append(self._store(postings, f"{POSTINGS}/{segment}"))
            note["segments"][segment] = {"n": added["n"], "dl": added["dl"]}
            note["next"] = added["last"] + 1
        before = dead.count()
        revived = dead.join(ids, key, "left_semi").count() if before else 0
        note |= {"tombstones": tombstones, "last": name}
        self._publish(folders, note, keep=True)
        return Change(segment, added["n"], revived, tombstones[0] - (before - revived))

    def _in_small_tasks(self) -> SparkSession:
        """A session of its own, as the size of a scan's tasks is a setting of the session."""
        spark = apply_conf(self.spark.newSession())
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(STAGED_BYTES))
        return spark

    def _sorted(self, postings: DataFrame, rows: int) -> DataFrame:
        files = max(1, math.ceil(rows / ROWS_PER_FILE))
        return postings.repartitionByRange(files, "term", "num").sortWithinPartitions("term", "num")

    # -- tombstones: the documents that are gone, and a bit for each by number

    def _store_dead(self, gone: DataFrame) -> tuple[list, list[int]]:
        """The folders of tombstones and their bits, and the sums: documents, tokens, rows of bits."""
        stored = self._store(gone, TOMBSTONES)
        dead = self.spark.read.parquet(f"{self.path}/{stored[1]}")
        bits = dead.groupBy(F.shiftright("num", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(num & 63 AS INT)))").alias("bits"))
        folders = [stored, self._store(bits, BITS)]
        sums = dead.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("dl")).first()
        return folders, [sums["n"], sums["dl"], self.spark.read.parquet(f"{self.path}/{folders[1][1]}").count()]

    def _live(self, df: DataFrame, version: V.Version, note: dict) -> DataFrame:
        """The rows (documents or postings) whose document is not gone."""
        if not note["tombstones"][0]:
            return df
        bits = self._read(version, BITS, self._schema(BITS, ""))
        if note["tombstones"][2] <= BROADCAST_ROWS:
            bits = F.broadcast(bits)
        alive = F.expr("bits IS NULL OR getbit(bits, CAST(num & 63 AS INT)) = 0")
        return df.withColumn("word", F.shiftright("num", 6)).join(bits, "word", "left").where(alive).select(df.columns)

    def _publish(self, folders: list, note: dict, keep: bool) -> None:
        V.publish(self.spark, self.path, folders[0][1].partition("=")[2], tuple(folders), keep=keep, note=json.dumps(note))

    # -- merging

    def merge(self, segments: Sequence[str] | None = None) -> str | None:
        """Write segments (None: all) together as one, without their tombstones. Returns its name."""
        version, note = self._current()
        chosen = sorted(note["segments"]) if segments is None else sorted(set(segments) & set(note["segments"]))
        if not chosen or (len(chosen) == 1 and not note["tombstones"][0]):
            return None
        key = self.id_col
        by_name = dict(version.folders)
        at = lambda kind: self.spark.read.parquet(*(f"{self.path}/{by_name[f'{kind}/{s}']}" for s in chosen))
        dead = self.spark.read.parquet(*self._folders(version, TOMBSTONES))
        docs, postings = (self._live(at(kind), version, note) for kind in (DOCS, POSTINGS))
        name = f"{chosen[0]}..{chosen[-1]}" if len(chosen) > 1 else f"{chosen[0]}+"
        stored = self._store(docs, f"{DOCS}/{name}")
        sums = self.spark.read.parquet(f"{self.path}/{stored[1]}").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("dl")).first()
        rows = at(POSTINGS).count()  # from the files' footers; an upper bound that only sizes the files
        folders = [stored, self._store(self._sorted(postings, rows), f"{POSTINGS}/{name}")]
        # tombstones of other segments stay
        left = dead.join(at(DOCS).select(key), key, "left_anti")
        dead_folders, tombstones = self._store_dead(left)
        folders += dead_folders
        gone = {f"{kind}/{s}" for kind in (DOCS, POSTINGS) for s in chosen} | {TOMBSTONES, BITS}
        folders += [(k, f) for k, f in version.folders if k not in gone]
        kept = {s: v for s, v in note["segments"].items() if s not in chosen}
        note |= {"segments": kept | {name: {"n": sums["n"], "dl": sums["dl"]}}, "tombstones": tombstones}
        self._publish(folders, note, keep=False)
        return name

    # -- reading

    def index(self) -> TextIndex:
        """The live index, for ``text_index.bm25_scores``, ``scored_rows`` and ``search``."""
        version, note = self._current()
        if version is None:
            raise ValueError(f"{self.path}: no snapshot was added yet")
        key = self.id_col
        id_type = self.spark.read.parquet(*self._folders(version, TOMBSTONES)).schema[key].dataType.simpleString()
        docs, stored = (self._read(version, kind, self._schema(kind, id_type)) for kind in (DOCS, POSTINGS))
        postings = self._live(stored, version, note)
        terms = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        n = sum(s["n"] for s in note["segments"].values()) - note["tombstones"][0]
        tokens = sum(s["dl"] for s in note["segments"].values()) - note["tombstones"][1]
        named = stored.join(self._live(docs, version, note).select("num", key), "num").select("term", key, "tf", "dl")
        return TextIndex(named, terms, n, tokens / n if n else 0.0, key, self.stop_words, self.stemmer)
