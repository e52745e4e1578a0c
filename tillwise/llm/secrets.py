"""Secret scan over a ledger of content-addressed texts; built-in expressions only.

Every version of a text is a blob, named by the SHA-256 of its bytes. The ledger holds, per blob and
rule version, the spans that rule found (none, too). A scan reads only pairs of blob and rule
version that the ledger lacks, appends them, and joins the ledger's spans back to all paths.

Positions: ``regexp_extract_all`` gives the matches and ``split`` the text between them; the running
sum of their lengths (in code points), over a blob's matches of one rule in order, is where each
match begins. So spans are leftmost and non-overlapping per rule, as the pattern engine finds them.
Only lengths are summed and shuffled, so a text of many findings costs in proportion to them.

Defined results: a null text is the empty text; an empty table gives no rows and leaves the ledger
as it was; repeated rows come back as often as they came in; a null path is a path; a very long text is read
whole, in one task. Columns of other names pass unread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillwise import scratch
from tillwise.operators.skew import join_per_key


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``pattern``, and how long its group ``part`` must be (in code points)."""
    kind: str
    pattern: str
    part: int
    least: int
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1),
    Rule("forge", r"(?:ghp|gho|ghs|ghu|glpat|xox[abprs])[_-][A-Za-z0-9_-]{20,}", 0, 1),
)
RULES = BASE + MORE
SPAN = "array<struct<start: int, stop: int>>"
MATCHES = "array<struct<gap: int, size: int, part: int>>"
LEDGER = f"blob string, rule string, spans {SPAN}"


def matches(text: Column, rule: Rule) -> Column:
    """The rule's matches in order: how far each begins behind the one before, and the lengths of
    the match and of its part, in code points."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.part)) if rule.part else hits
    between = F.split(text, rule.pattern, -1)
    triples = F.arrays_zip(F.slice(between, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), parts.alias("part"))
    return F.when(text.rlike(rule.pattern), F.transform(triples, lambda x: F.struct(
        F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("size"), F.length(x["part"]).alias("part")))
    ).otherwise(F.expr(f"CAST(array() AS {MATCHES})"))


def spans(matched: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rule, matches) to (blob, rule, spans): start and end (exclusive) of the matches that
    are long enough. Running sums over a text's matches; texts without any pass by the shuffle."""
    least = F.element_at(F.create_map(*(F.lit(x) for r in rules for x in (r.name, r.least))), F.col("rule"))
    # Repeated rows carry a blob more than once, with equal matches.
    some = (matched.where(F.size("matches") > 0).groupBy("blob", "rule").agg(F.first("matches").alias("matches"))
            .select("blob", "rule", F.posexplode("matches").alias("n", "x")))
    upto = Window.partitionBy("blob", "rule").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = some.withColumn("stop", F.sum(F.col("x.gap") + F.col("x.size")).over(upto).cast("int"))
    span = F.struct((F.col("stop") - F.col("x.size")).alias("start"), "stop")
    found = placed.groupBy("blob", "rule").agg(F.sort_array(F.collect_list(
        F.when(F.col("x.part") >= least, span))).alias("spans"))
    none = matched.where(F.size("matches") == 0).select("blob", "rule", F.expr(f"CAST(array() AS {SPAN})").alias("spans"))
    return none.unionByName(found)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger so far; one that has not begun is empty."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan(paths: DataFrame, path: str, text: str, ledger: str, rules: tuple[Rule, ...] = RULES
         ) -> DataFrame:
    """Scan what the ledger lacks, and return (path, spans: rule to spans) for each row.

    ``ledger`` is a folder; a scan appends to it and a later one, with more texts or a new version
    of a rule, reads only the difference. If a scan is repeated after a failure its rows come twice
    and are read as one.
    """
    spark = paths.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    whole = paths.select(F.col(path).alias("path"), body.alias("body"),
                         F.sha2(body, 256).alias("blob"))
    versions = scratch.stored(spark, whole.select("path", "blob"), "paths")
    # One path carries each blob to the scan; the hot blobs' other rows stay behind.
    carriers = versions.groupBy("blob").agg(F.min(F.struct("path")).alias("carrier"))
    wanted = carriers.select("blob", F.col("carrier.path").alias("path"),
                             F.explode(F.array(*(F.lit(r.name) for r in rules))).alias("rule"))
    unseen = (wanted.join(read_ledger(spark, ledger).select("blob", "rule").distinct(),
                          ["blob", "rule"], "left_anti")
              .groupBy("blob", "path").agg(F.collect_set("rule").alias("due")))
    # Carriers differ in blob and path, so no key of this join is hot.
    due = whole.join(unseen, (whole.blob == unseen.blob) & whole.path.eqNullSafe(unseen.path)
                     ).select(whole.blob, "body", "due")
    each = F.filter(F.array(*(
        F.when(F.array_contains("due", rule.name),
               F.struct(F.lit(rule.name).alias("rule"), matches(F.col("body"), rule).alias("matches")))
        for rule in rules)), lambda x: x.isNotNull())
    # An empty result of an empty table would leave a folder without files, which is fine to read.
    matched = scratch.stored(spark, due.select("blob", F.explode(each).alias("x")).select("blob", "x.rule", "x.matches"), "matches")
    spans(matched, rules).write.mode("append").parquet(ledger)
    now = [r.name for r in rules]
    found = (read_ledger(spark, ledger).where(F.col("rule").isin(now) & (F.size("spans") > 0))
             .distinct().groupBy("blob")
             .agg(F.map_from_entries(F.collect_list(F.struct("rule", "spans"))).alias("spans")))
    return join_per_key(versions, found, "blob", "left", deal_by=["path"]).select("path", "spans")


def _listed(found: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of all spans, by start and then the rules' order, comma-joined."""
    none = F.expr(f"CAST(array() AS {SPAN})")

    def said(i: int, rule: Rule) -> Column:
        own = F.coalesce(F.try_element_at(found, F.lit(rule.name)), none)
        return F.transform(own, lambda s: F.struct(
            s["start"].alias("start"), F.lit(i).alias("at"),
            F.concat_ws(":", F.lit(rule.kind), s["start"], s["stop"]).alias("said")))

    entries = F.concat(*(said(i, rule) for i, rule in enumerate(rules)))
    return F.array_join(F.transform(F.array_sort(entries), lambda x: x["said"]), ",")


def secret_scan(documents: DataFrame, ledger: str) -> DataFrame:
    """Per document the base kinds' counts, a digest of their spans, and all spans."""
    found = scan(documents, "doc_id", "text", ledger)
    known = F.coalesce("spans", F.expr(f"CAST(map() AS map<string, {SPAN}>)"))
    none = F.expr(f"CAST(array() AS {SPAN})")
    counts = [F.size(F.coalesce(F.try_element_at("known", F.lit(r.name)), none)).cast("long")
              .alias(f"n_{r.kind}") for r in BASE]
    return (found.select(F.col("path").alias("doc_id"), known.alias("known"))
            .select("doc_id", *counts,
                    F.sha2(_listed(F.col("known"), BASE), 256).alias("base_sha256"),
                    _listed(F.col("known"), RULES).alias("spans")))
