"""How often every distinct term occurs, kept up to date by signed deltas.

The counts of a collection are a table in the shared folder, partitioned by a hash
of the term, beside the digests and terms of its records. A change to the collection
comes as signed records: +1 for the new state of an added or changed record, -1 for
the old state of a changed or deleted one. Only these are aggregated, and the result
is merged into the buckets it touches; a first load is the case where every record
was added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import nfc
from ..session import folders, fresh_path, is_whole, settle, table

#: Rows of a bucket, about; the first load of a table of counts sets how many buckets it has.
BUCKET_ROWS = 500_000
RARE_BELOW = 3
COMMON_SHARE = 0.1


def normal_term(tag: Column) -> Column:
    """NFC, trimmed of blanks, in lower case; empty becomes null."""
    return F.nullif(F.lower(F.trim(nfc(tag))), F.lit(""))


def record_terms(tagged: DataFrame) -> DataFrame:
    """(record, term, occurrences) from rows (record, tag, occurrences), by term.

    Rows with a null record are left out, as are null, empty and blank tags.
    """
    named = tagged.where("record is not null").withColumn("term", normal_term(F.col("tag"))).where("term is not null")
    return named.groupBy("record", "term").agg(F.sum("occurrences").alias("occurrences"))


def signed_changes(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """(record, term, occurrences, sign) of what differs between two states with the columns of ``record_terms``.

    A record's terms are compared one by one, so a changed record costs only the terms
    that changed.
    """
    new = after.select("record", "term", "occurrences", F.lit(1).alias("sign"))
    if before is None:
        return new
    both = new.unionByName(before.select("record", "term", "occurrences", F.lit(-1).alias("sign")))
    return both.groupBy("record", "term", "occurrences").agg(F.sum("sign").alias("sign")).where("sign <> 0")


def record_digests(terms: DataFrame) -> DataFrame:
    """(record, n, digest): one row a record, from sums, so that a record of any size is digested in parts."""
    return terms.groupBy("record").agg(F.count("*").alias("n"), F.sum(F.xxhash64("term", "occurrences").cast("decimal(20,0)")).alias("digest"))


def term_deltas(changes: DataFrame) -> DataFrame:
    """(term, occurrences, records): what the signed changes add to each term's counts."""
    return changes.groupBy("term").agg(
        F.sum(F.col("occurrences") * F.col("sign")).alias("occurrences"), F.sum("sign").cast("bigint").alias("records")
    )


class TermCounts:
    """The persistent counts of one collection in a folder, and the records they were made from.

    ``counts`` are bucketed by a hash of the term; ``records``, the terms of each record,
    and their ``digests`` by one of the record. ``versions`` say which version of each
    bucket holds. An update writes only the buckets it touches, beside the ones before,
    and its version last, so one that fails leaves everything as it was; an object opened
    on the folder goes on from the last whole version.
    """

    schemas = {
        "counts": "term string, occurrences bigint, records bigint",
        "records": "record string, term string, occurrences bigint",
        "digests": "record string, n bigint, digest decimal(30,0)",
    }
    keys = {"counts": "term", "records": "record", "digests": "record"}

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or fresh_path(spark, "term-counts")
        written = (int(name[2:]) for name in folders(spark, f"{self.path}/versions"))
        self.version = max((v for v in written if is_whole(spark, f"{self.path}/versions/v={v}")), default=0)
        #: For each table the number of buckets, and the version of each that isn't empty.
        self.buckets: dict[str, int] = {}
        self.at: dict[str, dict[int, int]] = {t: {} for t in self.schemas}
        if self.version:
            for r in spark.read.parquet(f"{self.path}/versions/v={self.version}").collect():  # a row a bucket
                self.buckets[r.table] = r.buckets
                if r.bucket is not None:
                    self.at[r.table][r.bucket] = r.version

    def _read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        at = self.at[table]
        paths = [f"{self.path}/{table}/v={v}/bucket={b}" for b, v in at.items() if buckets is None or b in buckets]
        return self.spark.read.schema(self.schemas[table]).parquet(*paths) if paths else self.spark.createDataFrame([], self.schemas[table])

    def counts(self) -> DataFrame:
        """(term, occurrences, records) as of the last update."""
        return self._read("counts")

    def _bucketed(self, table: str, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(self.keys[table]), F.lit(self.buckets[table])).cast("int"))

    def _touched(self, table: str, keyed: DataFrame) -> list[int]:
        """The buckets that hold the keys; at most as many as there are buckets."""
        return [r.bucket for r in self._bucketed(table, keyed).select("bucket").distinct().collect()]

    def _replace(self, table: str, rows: DataFrame, touched: list[int], version: int) -> dict[int, int]:
        """Write the whole new content of the touched buckets; where each bucket of the table is then."""
        path = f"{self.path}/{table}/v={version}"
        self._bucketed(table, rows).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        kept = {b: v for b, v in self.at[table].items() if b not in touched}
        return kept | {int(name.split("=")[1]): version for name in folders(self.spark, path) if name.startswith("bucket=")}

    def update(self, after: DataFrame) -> TermCounts:
        """Bring the counts up to the state ``after``, which has the columns of ``record_terms``.

        Only records whose digest is new, differs or is gone are looked into, only their
        terms are aggregated, and only the buckets of these terms and records are written.
        """
        after = settle(after.select("record", "term", F.col("occurrences").cast("bigint").alias("occurrences")))
        new, old = record_digests(after), self._read("digests")
        both = new.alias("n").join(old.alias("o"), "record", "full_outer")
        differ = ~(F.col("n.n").eqNullSafe(F.col("o.n")) & F.col("n.digest").eqNullSafe(F.col("o.digest")))
        changed = settle(both.where(differ).select("record", F.col("n.n").alias("n"), F.col("n.digest").cast("decimal(30,0)").alias("digest")))
        first = not self.version
        if first:
            size = after.count()
            self.buckets = {"records": max(1, -(-size // BUCKET_ROWS)), "digests": max(1, -(-changed.count() // BUCKET_ROWS)), "counts": max(1, -(-after.select("term").distinct().count() // BUCKET_ROWS))}
        elif changed.isEmpty():
            return self
        there = {t: None if first else self._touched(t, changed) for t in ("records", "digests")}
        held = self._read("records", there["records"])
        of_changed = held.join(changed.select("record"), "record", "left_semi")
        delta = settle(term_deltas(signed_changes(None if first else of_changed, after if first else after.join(changed.select("record"), "record", "left_semi"))))
        touched = self._touched("counts", delta)
        merged = self._read("counts", touched).unionByName(delta).groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))

        version, rest = self.version + 1, lambda df: df.join(changed.select("record"), "record", "left_anti")
        present = changed.where("n is not null")
        at = {
            "counts": self._replace("counts", merged.where("occurrences <> 0 or records <> 0"), touched, version),
            "records": self._replace("records", rest(held).unionByName(after.join(present.select("record"), "record", "left_semi")), there["records"] or [], version),
            "digests": self._replace("digests", rest(self._read("digests", there["digests"])).unionByName(present), there["digests"] or [], version),
        }
        rows = [(t, self.buckets[t], b, v) for t in self.schemas for b, v in (at[t] or {None: version}).items()]
        self.spark.createDataFrame(rows, "table string, buckets int, bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/v={version}")
        self.version, self.at = version, at
        return self


def marked(counts: DataFrame, all_records: DataFrame, rare_below: int = RARE_BELOW, common_share: float = COMMON_SHARE) -> DataFrame:
    """``counts`` with ``mark``: rare, common or null. ``all_records`` is one row, one column: how many records there are."""
    total = all_records.select(F.col(all_records.columns[0]).alias("total"))
    mark = F.when(F.col("occurrences") < rare_below, "rare").when(F.col("records") > F.col("total") * common_share, "common")
    return counts.crossJoin(F.broadcast(total)).withColumn("mark", mark)  # one row


CANDIDATES, SCORES = "bc_candidate.tags", "artist_tag_scores.tag"


def candidate_tags(candidates: DataFrame) -> DataFrame:
    """(record, tag, occurrences): the array elements, each candidate id once."""
    once = candidates.where("id is not null").groupBy("id").agg(F.max("tags").alias("tags"))
    return once.select(F.col("id").cast("string").alias("record"), F.explode("tags").alias("tag"), F.lit(1).alias("occurrences"))


def score_tags(scores: DataFrame) -> DataFrame:
    """(record, tag, occurrences): one occurrence for each artist, tag as stored and model."""
    once = scores.groupBy("artist_id", "tag", "model").agg(F.lit(1).alias("occurrences"))
    return once.select(F.col("artist_id").alias("record"), "tag", "occurrences")


def _fields(spark, sf_dir: str):
    candidates, scores = table(spark, sf_dir, "bc_candidate"), table(spark, sf_dir, "artist_tag_scores")
    yield CANDIDATES, candidates, candidate_tags, "id", "first_seen_at"
    yield SCORES, scores, score_tags, "artist_id", "computed_at"


def kept_counts(spark, rows: DataFrame, tags, time: str) -> TermCounts:
    """Counts loaded with what is there up to the median time, then opened anew and brought up to date by what came since."""
    cut = rows.select(F.expr(f"percentile_approx({time}, 0.5)").alias("cut"))
    early = rows.join(F.broadcast(cut), F.col(time) <= F.col("cut")).drop("cut")  # one row
    loaded = TermCounts(spark).update(record_terms(tags(early)))
    return TermCounts(spark, loaded.path).update(record_terms(tags(rows)))


def term_marks(spark, sf_dir: str) -> DataFrame:
    """(field_name, term, occurrences, records, mark) of every term of both fields."""
    found = []
    for name, rows, tags, record, time in _fields(spark, sf_dir):
        total = rows.select(F.count_distinct(record))
        found.append(marked(kept_counts(spark, rows, tags, time).counts(), total).select(F.lit(name).alias("field_name"), "term", "occurrences", "records", "mark"))
    return found[0].unionByName(found[1])


def p3_found(spark, sf_dir: str) -> DataFrame:
    return term_marks(spark, sf_dir).where("mark is not null").select("field_name", "term", "mark")


def p3_counts(spark, sf_dir: str) -> DataFrame:
    """The counts of a first load alone, as every record was added."""
    found = [
        TermCounts(spark).update(record_terms(tags(rows))).counts().select(F.lit(name).alias("field_name"), "term", "occurrences", "records")
        for name, rows, tags, _, _ in _fields(spark, sf_dir)
    ]
    return found[0].unionByName(found[1])


def p3_increment(spark, sf_dir: str) -> DataFrame:
    """The counts of each field as of its median time, brought up to date by what came or changed since."""
    return term_marks(spark, sf_dir).select("field_name", "term", "occurrences", "records")


_COUNTS_SQL = """
with tagged as (
  select 'bc_candidate.tags' as field_name, id::varchar as record, unnest(tags) as tag
  from (select distinct on (id) id, tags from bc_candidate where id is not null order by id, tags desc nulls last)
  union all
  select 'artist_tag_scores.tag', artist_id, tag from (select distinct artist_id, tag, model from artist_tag_scores)
), terms as (
  select field_name, record, lower(trim(nfc_normalize(tag))) as term from tagged where record is not null
), counts as (
  select field_name, term, count(*) as occurrences, count(distinct record) as records
  from terms where term is not null and term <> '' group by all
), totals as (
  select 'bc_candidate.tags' as field_name, count(distinct id) as total from bc_candidate
  union all select 'artist_tag_scores.tag', count(distinct artist_id) from artist_tag_scores
)
"""
QUERIES = {"p3_found": p3_found, "p3_counts": p3_counts, "p3_increment": p3_increment}
SQL = {
    "p3_found": _COUNTS_SQL
    + """select field_name, term, case when occurrences < 3 then 'rare' else 'common' end as mark
    from counts join totals using (field_name) where occurrences < 3 or records > total * 0.1""",
    "p3_counts": _COUNTS_SQL + "select field_name, term, occurrences, records from counts",
    "p3_increment": _COUNTS_SQL + "select field_name, term, occurrences, records from counts",
}
