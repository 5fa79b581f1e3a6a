"""Secret scanning over an incremental ledger of blobs.

Every version of every file is a blob, named by the SHA-256 of its content. The ledger remembers which blob has
been searched by which version of which rule, and what was found. A scan takes any number of (path, content)
rows, reduces them to distinct blobs, leaves out the pairs of blob and rule version that the ledger has, searches
only the rest, appends one entry per searched blob, and joins the findings of each blob back to
all paths that hold it. The same content under another path costs a hash; raising one rule's version searches
again for that rule alone.

Only DataFrame expressions are used. A text that can match is split by the pattern; the lengths of pieces and
matches, summed over a window per blob and rule, give the positions, so a text with very many spans stays linear.

Defined results: a null content counts as empty; an empty blob has no findings; repeated rows share one blob and
each gets its findings; a null path is a path like any other; only the named columns are read. Positions count
code points, ends are exclusive. After a scan that died, the next one searches what has no entry.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringledger.llm.common import let
from ringledger.llm.components import spread_join


@dataclass(frozen=True)
class Rule:
    """A pattern, the least length of a match (of its group ``group``), and a version to raise when they change.

    ``holds`` is a pattern that every text with a finding contains; it only saves work.
    """

    kind: str
    pattern: str
    least: int
    holds: str
    group: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", _ASSIGN + r"([A-Za-z0-9+/_.=-]+)", 12, _ASSIGN + r"[A-Za-z0-9+/_.=-]{12}", group=2),
    Rule("access", r"AKIA[A-Z0-9]+", 18, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", r"[0-9a-f]+", 16, r"[0-9a-f]{16}"),
)
_JWT = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.eyJ"
EXTRA_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40, r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 39, r"AIza[0-9A-Za-z_-]{35}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]+", 24, r"xox[abprs]-[0-9A-Za-z-]{19}"),
    # Not from within a run of its own signs, or a long run would be gone through once per start.
    Rule("jwt", rf"{_JWT}[A-Za-z0-9_-]++\.[A-Za-z0-9_-]+", 40, _JWT, version=2),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 27, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE_RULES + EXTRA_RULES

_PIECES = "array<struct<rule:string,kind:string,at:int,gap:int,hit:int,enough:boolean>>"
_ENTRY = f"blob binary, rules array<string>, pieces {_PIECES}"


def _pieces(text: Column, rule: Rule) -> Column:
    """Per match, in order: the code points before it since the last one, its own, and if it is long enough."""

    def measured(found: Column) -> Column:
        return F.transform(
            found["hits"],
            lambda hit, i: F.struct(
                F.lit(rule.key).alias("rule"),
                F.lit(rule.kind).alias("kind"),
                i.alias("at"),
                F.length(F.get(found["gaps"], i)).alias("gap"),
                F.length(hit).alias("hit"),
                (F.length(F.get(found["groups"], i)) >= rule.least).alias("enough"),
            ),
        )

    found = F.struct(
        F.split(text, rule.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("groups"),
    )
    return F.when(text.rlike(rule.holds), let(found, measured))


class BlobLedger:
    """The ledger in one folder; every entry stands for itself, so entries of a write that died halfway are right too."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def entries(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_ENTRY).parquet(self.folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def scan(self, versions: DataFrame, content: str = "text", rules: Iterable[Rule] = RULES) -> DataFrame:
        """Search what is unseen among the versions, then return every finding of every path.

        Result: the other columns of ``versions``, ``blob``, and ``findings``, an array of (kind, start, end)
        ordered by start and the rules' order, empty where there are none. Columns of ``versions`` that have these
        two names are left out.
        """
        rules = list(rules)
        keys = F.array(*[F.lit(r.key) for r in rules])
        body = F.coalesce(F.col(content), F.lit(""))
        blob = F.unhex(F.sha2(body, 256))
        blobs = versions.select(blob.alias("blob"), body.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
        entries = self.entries()
        if entries is None:
            todo = blobs.withColumn("todo", keys)
        else:
            seen = entries.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen"))
            todo = (
                blobs.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
                .where(F.size("todo") > 0)
            )
        nothing = F.array().cast(_PIECES)
        searched = F.concat(
            *[F.coalesce(F.when(F.array_contains("todo", r.key), _pieces(F.col("text"), r)), nothing) for r in rules]
        )
        entry = todo.select("blob", F.col("todo").alias("rules"), searched.alias("pieces"))
        entry.write.mode("append").parquet(self.folder)
        order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
        per_blob = (
            self.findings(rules)
            .groupBy(F.col("blob").alias("_blob"))
            .agg(F.array_sort(F.collect_list(F.struct("start", order[F.col("kind")].alias("rank"), "kind", "end"))).alias("_found"))
        )
        others = [n for n in versions.columns if n not in (content, "blob", "findings")]
        paths = versions.select(F.struct(F.lit(0), *[F.col(f"`{n}`") for n in others]).alias("_path"), blob.alias("_blob"))
        found = F.transform(
            F.coalesce("_found", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")),
            lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")),
        )
        return spread_join(paths, per_blob, "_blob", "left").select(
            *[F.col(f"_path.`{n}`").alias(n) for n in others], F.lower(F.hex("_blob")).alias("blob"), found.alias("findings")
        )

    def findings(self, rules: Iterable[Rule] = RULES) -> DataFrame:
        """All findings of these rule versions: blob, kind, start, end."""
        entries = self.entries()
        if entries is None:
            return self.spark.createDataFrame([], "blob binary, kind string, start bigint, end bigint")
        piece = entries.where(F.size("pieces") > 0).select("blob", F.explode("pieces").alias("p")).select("blob", "p.*")
        # Two scans at a time may both have searched a blob; their pieces are equal.
        piece = piece.where(F.col("rule").isin([r.key for r in rules])).dropDuplicates(["blob", "rule", "at"])
        so_far = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum(F.col("gap").cast("long") + F.col("hit")).over(so_far)
        placed = piece.withColumn("end", end).where("enough")
        return placed.select("blob", "kind", (F.col("end") - F.col("hit")).alias("start"), "end")
