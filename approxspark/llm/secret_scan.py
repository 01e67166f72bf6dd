"""Operator 13: secret scan of a history of files through an incremental blob ledger, by DataFrame functions alone.

Every version of every file is content-addressed: its blob is the SHA-256 of its text. A ledger says
which blobs have been scanned by which version of which rule, and what was found. A scan looks only at pairs
of a blob and a rule version that the ledger hasn't seen, each once however many paths and versions
share the blob, adds them to the ledger, and joins findings back to all paths.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import list_scratch, scratch_path, store
from .hot import left_join


@dataclass(frozen=True)
class Rule:
    """A pattern (leftmost matches that don't overlap); matches whose ``group`` is shorter than ``least`` characters are dropped.

    ``near`` is a literal that every match contains, if there is one: texts without it are passed over. A
    changed pattern needs a new ``version``, so that blobs seen by the old one are scanned again.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    near: str | None = None
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


#: The base rules.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, near="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs of 24 or more among all maximal runs
)
#: Public formats of credentials that the base rules miss or tell only in part.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", near="PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", near="_"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", near="xox"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", near="AIza"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", near="eyJ"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%-]{1,64}:[A-Za-z0-9._~%!$&*+=-]{3,128}@", near="://"),
)
RULES = BASE + MORE

SPAN = "struct<rule:string,start:bigint,end:bigint>"
#: Unseen blobs of which every task can have a list; beyond that texts are grouped before the others are left out.
FEW = 50_000


def blob_of(text: Column) -> Column:
    """A text's content address; null counts as empty."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


class Ledger:
    """Scanned pairs and findings below a folder that driver and executors share.

    ``findings`` are written before ``scans``: a pair counts as seen only once its findings are stored, so a
    scan that is stopped is done again, and spans written twice count once.
    """

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path or scratch_path(spark, "ledger")

    def _read(self, name: str, schema: str) -> DataFrame:
        there = any(not n.startswith(("_", ".")) for n in list_scratch(self.spark, f"{self.path}/{name}"))
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    def scans(self) -> DataFrame:
        """blob, rules: the keys of the rule versions that have scanned it."""
        return self._read("scans", "blob string, rules array<string>")

    def findings(self, rules: Sequence[Rule]) -> DataFrame:
        """blob, spans: what these rules' versions have found, by place and rule."""
        place = F.array_position(F.array(*[F.lit(r.key) for r in rules]), F.col("key"))
        found = self._read("findings", "blob string, key string, start bigint, `end` bigint").where(place > 0)
        span = F.struct("start", place.alias("place"), F.struct(F.substring_index("key", "@", 1).alias("rule"), "start", "end").alias("span"))
        found = found.groupBy("blob").agg(F.array_sort(F.collect_set(span)).alias("_s"))
        return found.select("blob", F.transform("_s", lambda s: s["span"]).cast(f"array<{SPAN}>").alias("spans"))

    def add(self, scanned: DataFrame, found: DataFrame) -> None:
        for name, rows in (("findings", found), ("scans", scanned)):
            rows.write.mode("append").option("compression", "zstd").parquet(f"{self.path}/{name}")


def _unseen(blobs: DataFrame, ledger: Ledger, rules: Sequence[Rule]) -> DataFrame:
    """Blobs with the keys of the rules that haven't scanned them; blobs seen by all are left out."""
    wanted = F.array(*[F.lit(r.key) for r in rules])
    done = ledger.scans().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("_done"))
    todo = blobs.select("blob").join(done, "blob", "left")
    todo = todo.select("blob", F.array_except(wanted, F.coalesce("_done", F.array().cast("array<string>"))).alias("rules"))
    return todo.where(F.size("rules") > 0)


def _matches(rule: Rule, text: Column) -> Column:
    """The rule's matches in order, each with the number of characters before it since the last one.

    Java's splitting and extracting find the same matches, so the texts between and the matches alternate.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    columns = [whole, F.split(text, rule.pattern, -1)]
    if rule.group:
        columns.append(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)))
    # the last text between follows no match
    rows = F.transform(F.filter(F.arrays_zip(*columns), lambda m: m["0"].isNotNull()), lambda m, i: F.struct(
        F.lit(rule.key).alias("key"), i.alias("i"), F.length(m["1"]).cast("long").alias("gap"), F.length(m["0"]).cast("long").alias("n"),
        (F.length(m["2" if rule.group else "0"]) >= rule.least).alias("ok")))
    found = text.rlike(rule.pattern)
    return F.when(text.contains(rule.near) & found if rule.near else found, rows)


def find(texts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Matches in ``texts`` (blob, text, rules: the keys to look for): blob, key, start, end, in code points."""
    found = F.array(*[F.when(F.array_contains("rules", r.key), _matches(r, F.col("text"))) for r in rules])
    found = texts.select("blob", F.explode(F.flatten(F.filter(found, lambda x: x.isNotNull()))).alias("m")).select("blob", "m.*")
    so_far = Window.partitionBy("blob", "key").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far))
    return found.where("ok").select("blob", "key", (F.col("end") - F.col("n")).alias("start"), "end")


def scan(
    versions: DataFrame,
    path_cols: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    ledger: Ledger | None = None,
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """One row per version: the path columns, blob (SHA-256 of the text) and spans (rule, start, end by place, then rule).

    Starts and ends count code points, ends are exclusive. Spans of one rule don't overlap, those of two may. Whole
    texts are scanned, null as empty; each row of ``versions`` is answered, whether paths repeat or are null; versions
    without a finding have no spans; an empty table gives no rows; other columns of any name are not read. The
    ledger (a fresh one by default) has seen every pair of blob and rule version afterwards.
    """
    ledger = ledger or Ledger(versions.sparkSession)
    paths = F.struct(*path_cols).alias("_path")
    rows, _ = store(versions.select(paths, blob_of(F.col(text_col)).alias("blob"), F.monotonically_increasing_id().alias("_row")), "versions")
    total = rows.count()
    unseen, _ = store(_unseen(rows.select("blob").distinct(), ledger, rules), "unseen")
    texts = versions.select(blob_of(F.col(text_col)).alias("blob"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if unseen.count() <= FEW:  # other blobs' texts stay where they are
        texts = texts.join(F.broadcast(unseen.select("blob")), "blob", "left_semi")
    # one text for each unseen blob: copies meet in each task first, so that no blob is hot
    texts = texts.groupBy("blob").agg(F.first("text").alias("text")).join(unseen, "blob")
    found, _ = store(find(texts, rules), "found")
    ledger.add(unseen, found)
    joined = left_join(rows, ledger.findings(rules), "blob", total, "_row")
    return joined.select(*[F.col(f"_path.{c}").alias(c) for c in path_cols], "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def digest(spans: Column) -> Column:
    """``rule:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")
