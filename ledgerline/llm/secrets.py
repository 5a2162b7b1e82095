"""Secret scans over all historical versions of files, through a ledger of contents.

Every version is named by the SHA-256 of its content (a blob). The ledger holds, per blob, which rule versions have
scanned it and what they found. A run scans only the pairs of blob and rule version that the ledger does not know, each
blob once however many paths and versions hold it, and then joins the findings back to all of them. Everything is an
expression of the JVM: positions come from splitting the text at the matches of a rule.

Null and empty texts have no findings, an empty table gives an empty ledger and result. A text is one value of a row: a
task holds some six copies of the longest; n matches in one text cost n to the power of 1.5.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.llm.expressions import let, places
from ledgerline.workspace import new_dir


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds spans, leftmost and non-overlapping; group ``group`` must have ``least`` characters.

    ``guard`` is a cheap pattern that each text with a match also matches. A new ``version`` makes all blobs unseen.
    """

    kind: str
    pattern: str
    guard: str
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"(?i)passw|secret|token|api_?key",
        group=2,
        least=6,
    ),
    # Greedy runs: a run that is too short for the rule holds no other match, so the length can be part of the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}", r"AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
    # Repetitions are bounded, so no text takes more than a fixed number of steps for each of its characters.
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]{1,20} ){0,6}PRIVATE KEY-----", r"PRIVATE KEY-----", version=2),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,400}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ", version=2),
)

_FINDING = "array<struct<start:int,turn:int,kind:string,rule:string,end:int>>"
_LEDGER = f"blob string, scanned array<string>, findings {_FINDING}"


def spans(text: Column, rule: Rule, turn: int) -> Column:
    """Findings of one rule, in code points."""

    def of_rule(found: Column) -> Column:
        return F.transform(
            found,
            lambda p: F.struct(
                p["start"].alias("start"), F.lit(turn).alias("turn"), F.lit(rule.kind).alias("kind"), F.lit(rule.key).alias("rule"),
                p["stop"].alias("end"),
            ),
        )

    found = places(text, F.lit(rule.pattern))
    if rule.least:
        sizes = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length)
        found = let(sizes, lambda n: F.filter(places(text, F.lit(rule.pattern)), lambda p, i: F.element_at(n, i + 1) >= rule.least))
    return F.when(text.rlike(rule.guard), of_rule(found).cast(_FINDING)).otherwise(F.array().cast(_FINDING))


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


class BlobLedger:
    """The ledger at ``root``; without a root, a new one in the shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root or new_dir(spark, "ledger")

    def read(self) -> DataFrame:
        """One row for each blob and run that scanned it: ``blob``, ``scanned``, ``findings``."""
        if not _exists(self.spark, self.root):
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(self.root)

    def _scanned(self) -> DataFrame:
        return self.read().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("_seen"))

    def scan(self, versions: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is unseen among ``versions`` and append it to the ledger, in one committed job.

        Copies of a content are merged before the shuffle and again after it. A run that dies leaves no part of its
        rows; a run repeated after its commit finds nothing to do. Null texts count as empty.
        """
        blobs = versions.select(content_of(text).alias("_text")).select(F.sha2("_text", 256).alias("blob"), "_text")
        unique = blobs.groupBy("blob").agg(F.first("_text").alias("_text"))
        known = _exists(self.spark, self.root)
        if known:
            unique = unique.join(self._scanned(), "blob", "left")
        else:
            unique = unique.withColumn("_seen", F.lit(None).cast("array<string>"))
        seen = F.coalesce(F.col("_seen"), F.array().cast("array<string>"))
        due = F.array_except(F.array(*[F.lit(r.key) for r in rules]), seen)
        found = [
            F.when(F.array_contains(F.col("scanned"), r.key), spans(F.col("_text"), r, k))
            .otherwise(F.array().cast(_FINDING))
            for k, r in enumerate(rules)
        ]
        pending = unique.withColumn("scanned", due).where(F.size("scanned") > 0)
        (
            pending.select("blob", "scanned", F.array_sort(F.concat(*found)).alias("findings"))
            .write.mode("append").option("compression", "zstd").parquet(self.root)
        )

    def findings(self, versions: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """``versions`` without its text, with ``blob`` and the sorted ``findings`` of the given rule versions.

        Every row of ``versions`` comes back, repeated rows too; columns ``blob`` and ``findings`` are replaced. Contents
        that were not scanned have null findings.
        """
        current = F.array(*[F.lit(r.key) for r in rules])
        own = F.filter("findings", lambda f: F.array_contains(current, f["rule"]))
        runs = F.collect_list(F.struct(F.array_intersect("scanned", current).alias("scanned"), own.alias("f")))
        begin = F.struct(F.array().alias("rules"), F.array().alias("out")).cast(f"struct<rules:array<string>,out:{_FINDING}>")

        def add(so_far: Column, run: Column) -> Column:
            """Findings of rules that no other run has brought: a blob has as many runs as scans, not as findings."""
            news = F.filter(run["f"], lambda f: ~F.array_contains(so_far["rules"], f["rule"]))
            return F.struct(
                F.concat(so_far["rules"], run["scanned"]).alias("rules"), F.concat(so_far["out"], news).alias("out")
            )

        one = self.read().groupBy("blob").agg(runs.alias("runs")).select(
            "blob", F.array_sort(F.aggregate("runs", begin, add)["out"]).alias("findings")
        )
        named = versions.withColumn("blob", F.sha2(content_of(text), 256)).drop(text, "findings")
        return named.join(one, "blob", "left")


def content_of(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def render(findings: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` joined by commas, by start, then by the order of the rules."""
    chosen = findings if kinds is None else F.filter(findings, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def count_of(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")
