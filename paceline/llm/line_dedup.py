"""Line dedup by winnowing: runs of lines that occur earlier are deleted where they occur again.

Every line is hashed. Of each window of `window` neighbouring grams (`gram` lines each) the least hash is selected, and
one row is kept for each selected position, with the windows it was selected by; so two equal runs of `window + gram - 1`
lines always select the same line of theirs. Fingerprints of positions that occur once are done. Where a fingerprint
recurs, positions are joined with the first one that has the same lines around it: each window a position stands for
is laid over its first occurrence, in order of id and line. Matches that touch or overlap grow together, both ways, to
the longest repeated runs, which are cut from all but the first.

So that no repeated passage stays because it has few lines, a line of `alone` bytes or more, and a whole text of fewer
lines than a run, are matched by themselves as well, with others of their kind.

Lines are told apart by 128 bits of hash: at 10^13 lines a false match has a chance below 10^-12. Only DataFrame
functions run here. Texts are split into lines once; counts and first occurrences are pre-aggregated and written before
they are joined, so a hot line costs no task more than its share.

Edge cases: null text has no lines and stays null; an empty text is one empty line, which never counts; overlapping
repeats inside one text count too; rows with a null id come last; rows of one id are ordered by a hash of their text,
and rows of equal id and text are treated alike, as one; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

_LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    """`alone`: bytes from which a line counts without neighbours; None where neither lines nor short texts do."""

    gram: int = 1
    window: int = 4
    alone: int | None = 200

    @property
    def run(self) -> int:
        return self.gram + self.window - 1


def _upto(n: Column) -> Column:
    """0, 1, ... below n."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _key(i: Column, n: Column | int, kind: str) -> Column:
    """128 bits of the `n` lines from line `i` on."""
    return F.struct(*[F.xxhash64(F.slice(h, i + 1, n), F.lit(kind)).alias(a) for a, h in (("a", "h"), ("b", "k"))])


def minima(docs: DataFrame, s: Settings) -> DataFrame:
    """doc, same, at (first line), n (lines), fingerprint and runs of every selected position, and of what counts alone.

    `runs` are the keys of the windows that selected the position; they begin at line `at` and those after it.
    """
    hashed = docs.withColumns({"h": F.transform("lines", lambda x: F.xxhash64(x)), "k": F.transform("lines", lambda x: F.xxhash64(F.lit(1), x))})
    grams = hashed.withColumn("g", F.col("h") if s.gram == 1 else F.transform(_upto(F.size("h") - s.gram + 1), lambda i: F.xxhash64(F.slice("h", i + 1, s.gram))))
    least = F.transform(_upto(F.size("h") - s.run + 1), lambda i: F.array_min(F.slice("g", i + 1, s.window)))
    where = grams.withColumn("least", least).withColumn("p", F.transform("least", lambda m, i: i + F.array_position(F.slice("g", i + 1, s.window), m).cast("int") - 1))
    # a row where another position is selected than by the window before
    changes = where.withColumn("first", F.filter(_upto(F.size("p")), lambda i: (i == 0) | (F.get("p", i) != F.get("p", i - 1))))
    stretch = lambda i, k: F.sequence(i, F.coalesce(F.get("first", k + 1), F.size("p")) - 1)
    row = lambda at, n, fingerprint, runs: F.struct(at.alias("at"), n.cast("int").alias("n"), fingerprint.alias("fingerprint"), runs.alias("runs"))
    each = F.transform("first", lambda i, k: row(i, F.lit(s.run), F.get("least", i), F.transform(stretch(i, k), lambda j: _key(j, s.run, "run"))))
    if s.alone is not None:
        long = F.filter(_upto(F.size("lines")), lambda i: F.octet_length(F.get("lines", i)) >= s.alone)
        each = F.concat(each, F.transform(long, lambda i: row(i, F.lit(1), F.xxhash64(F.get("h", i), F.lit("line")), F.array(_key(i, 1, "line")))))
        whole = F.array(row(F.lit(0), F.size("lines"), F.xxhash64("h", F.lit("text")), F.array(_key(F.lit(0), F.size("lines"), "text"))))
        short = (F.size("lines") < s.run) & ~((F.size("lines") == 1) & (F.get("lines", F.lit(0)) == ""))
        each = F.concat(each, F.when(short, whole).otherwise(F.slice(whole, 1, 0)))
    return changes.select("doc", "same", F.explode(each).alias("w")).select("doc", "same", "w.at", "w.n", "w.fingerprint", "w.runs")


def dedup_lines(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (what is left), n_lines, n_removed and n_runs, for every row."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = own.withColumns({"doc": F.coalesce("doc_id", F.lit(_LAST)), "same": F.xxhash64("text")})
    lines = keyed.where("text is not null").select("doc", "same", F.split("text", "\n", -1).alias("lines"))
    selected = written(minima(lines, settings), "minima")
    shared = written(selected.groupBy("fingerprint").agg(F.count("*").alias("c")).where("c > 1").select("fingerprint"), "fingerprints")
    met = selected.join(shared, "fingerprint", "left_semi").select("doc", "same", "at", "n", F.posexplode("runs").alias("later", "run"))
    seeds = written(met.select("doc", "same", (F.col("at") + F.col("later")).alias("at"), "n", F.col("run.a").alias("a"), F.col("run.b").alias("b")), "seeds")
    # a run that occurs once is no repeat; of others, what isn't first goes
    place = F.struct("doc", "same", "at")
    first = written(seeds.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("a", "b", "first"), "first")
    repeats = seeds.join(first, ["a", "b"]).where(F.col("first") < place)
    covered = F.flatten(F.collect_set(F.sequence("at", F.col("at") + F.col("n") - 1)))
    at = repeats.groupBy("doc", "same").agg(F.array_sort(F.array_distinct(covered)).alias("at"))
    # neighbours grow together; a run of lines begins where the line before stays
    begins = F.filter("at", lambda x, i: (i == 0) | (F.get("at", i - 1) + 1 < x))
    ends = F.transform(F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) > x + 1)), lambda x: x + 1)
    runs = at.select("doc", "same", begins.alias("begins"), ends.alias("ends"))
    joined = keyed.join(runs, ["doc", "same"], "left").withColumn("lines", F.split("text", "\n", -1))
    whole = F.col("begins").isNull()
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("begins")),
        lambda i: F.slice("lines", F.coalesce(F.get("ends", i - 1), F.lit(0)) + 1, F.coalesce(F.get("begins", i), F.size("lines")) - F.coalesce(F.get("ends", i - 1), F.lit(0))),
    )
    kept = F.when(whole, F.col("lines")).otherwise(F.flatten(pieces))
    return joined.withColumn("kept", kept).select(
        "doc_id",
        F.when(whole, F.col("text")).otherwise(F.array_join("kept", "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
        F.when(whole, 0).otherwise(F.size("begins")).cast("long").alias("n_runs"),
    )


def op9_line_winnowing(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: Every run of four lines, every line of 200 bytes and every text of fewer than four lines that occurred before.
OP9_SQL = """
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), r AS (
  SELECT doc_id, unnest(range(len(lines) - 3)) AS pos, lines FROM l WHERE len(lines) >= 4
), f AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY array_to_string(lines[pos + 1 : pos + 4], chr(10)) ORDER BY doc_id, pos) AS k FROM r
), every AS (
  SELECT doc_id, unnest(range(len(lines))) AS line, unnest(lines) AS s FROM l
), alone AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY s ORDER BY doc_id, line) AS k FROM every WHERE octet_length(encode(s)) >= 200
), short AS (
  SELECT doc_id, lines, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM l WHERE len(lines) < 4 AND text <> ''
), gone AS (
  SELECT doc_id, pos + d AS line FROM f, (VALUES (0), (1), (2), (3)) AS t(d) WHERE k > 1
  UNION SELECT doc_id, line FROM alone WHERE k > 1
  UNION SELECT doc_id, unnest(range(len(lines))) FROM short WHERE k > 1
), marked AS (
  SELECT e.doc_id, e.line, e.s, g.line IS NOT NULL AS gone,
    lag(g.line IS NOT NULL) OVER (PARTITION BY e.doc_id ORDER BY e.line) AS before
  FROM every e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.line = g.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  count(*) FILTER (WHERE gone AND NOT coalesce(before, false)) AS n_runs,
  sha256(coalesce(string_agg(CASE WHEN NOT gone THEN s END, chr(10) ORDER BY line), '')) AS kept_sha256
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, 0, sha256('') FROM documents WHERE text IS NULL
"""
