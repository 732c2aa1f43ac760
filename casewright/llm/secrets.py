"""Secret scan with an incremental blob ledger.

Every historical version of a text is addressed by its content. A ledger holds, for each (blob, rule, rule version)
scanned so far, the spans found. A run scans only pairs that the ledger lacks, and findings go back to every path
that ever held the blob. All of it is DataFrame functions: no Python touches a row.

Defined results: a null text counts as empty; repeated rows and equal texts share one blob, and each row gets its
findings; an empty table gives an empty result; columns other than those named are not looked at, so their names
can clash with nothing. Offsets are code points, the end exclusive. A span is the whole match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from casewright.llm.shared import cut_lineage


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched leftmost and without overlap; a match whose ``group`` is shorter than ``least`` is dropped."""

    name: str
    version: int
    pattern: str
    group: int
    least: int


# Fixed patterns of the scan. The two runs have their least length inside the pattern: a run is matched from its first
# possible start to its end, so a later start in it is shorter still, and no match changes.
RULES = (
    Rule("assign", 1, r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)
SPANS = "array<struct<start:bigint,end:bigint>>"
LEDGER = f"blob_id binary, rule string, rule_version int, spans {SPANS}"


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans of the rule's matches. Between the matches lie the pieces of a split by the same pattern, so running lengths give offsets."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    before = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole))
    none = F.array().cast(SPANS)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        end = start + F.length(x["whole"])
        span = F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))
        kept = F.when(F.length(x["part"]) >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.cast("bigint").alias("at"), kept.alias("spans"))

    zipped = F.arrays_zip(before.alias("before"), whole.alias("whole"), part.alias("part"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))
    return F.when(text.rlike(rule.pattern), F.aggregate(zipped, start, step, lambda acc: acc["spans"])).otherwise(none)


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan(versions: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows (``LEDGER``) for the (blob, rule version) pairs of ``versions`` that ``ledger`` lacks, as a written table."""
    column = F.coalesce(F.col(text), F.lit(""))
    blobs = versions.select(blob_id(F.col(text)).alias("blob_id"), column.alias("body")).groupBy("blob_id").agg(F.first("body").alias("body"))
    if ledger is None:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        seen = ledger.groupBy("blob_id").agg(F.collect_set(F.concat_ws("@", "rule", "rule_version")).alias("seen"))
        blobs = blobs.join(seen, "blob_id", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    rows = [
        F.when(
            ~F.array_contains("seen", f"{r.name}@{r.version}"),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version"), spans_of(F.col("body"), r).alias("spans")),
        )
        for r in rules
    ]
    found = blobs.select("blob_id", F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("f"))
    return cut_lineage(found.select("blob_id", "f.rule", "f.rule_version", "f.spans"))


def findings(versions: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None, carry: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(row, found)`` for each row of ``versions``, and the ledger's new rows.

    ``row`` is a struct of the ``carry`` columns (None: all), ``found`` one of each rule's spans. Most blobs have no
    finding: only blobs with one are joined to the paths, the others get empty lists.
    """
    new = scan(versions, text, rules, ledger)
    known = new if ledger is None else new.unionByName(ledger.select(new.columns))
    current = " OR ".join(f"(rule = '{r.name}' AND rule_version = {r.version})" for r in rules)
    lists = [F.first(F.when(F.col("rule") == r.name, F.col("spans")), ignorenulls=True).alias(r.name) for r in rules]
    by_blob = cut_lineage(known.where(current).where(F.size("spans") > 0).groupBy("blob_id").agg(*lists))
    by_blob = by_blob.select("blob_id", F.struct(*(F.coalesce(F.col(r.name), F.array().cast(SPANS)).alias(r.name) for r in rules)).alias("found"))
    none = F.struct(*(F.array().cast(SPANS).alias(r.name) for r in rules))
    rows = versions.select(F.struct(*(carry or versions.columns)).alias("row"), blob_id(F.col(text)).alias("blob_id"))
    return rows.join(by_blob, "blob_id", "left").select("row", F.coalesce("found", none).alias("found")), new


def listed(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans as ``kind:start:end``, by start, then kind in the rules' order, comma-joined."""

    def tagged(k: int) -> Column:
        return F.transform(found[rules[k].name], lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end")))

    names = F.array(*(F.lit(r.name) for r in rules))
    return F.array_join(F.transform(F.array_sort(F.concat(*map(tagged, range(len(rules))))), lambda s: F.concat_ws(":", names[s["k"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, found: Column, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> Column:
    """``text`` with each span, or overlapping spans together, replaced by ``mark``; null stays null."""
    spans = F.array_sort(F.concat(*(found[r.name] for r in rules)))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        more = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(done)
