"""Incremental secret scans over a ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger remembers which
rule versions each blob was scanned with and what was found. A run scans one copy of each blob
with the rules it lacks, appends to the ledger, and joins the findings back to all paths.
Built-in functions only; whole texts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm.common import let, materialize, pick_name, scratch_dir


class Rule(NamedTuple):
    """Maximal matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    The pattern holds for Java and for RE2 alike. Raise ``version`` with every change: blobs
    scanned with another version are scanned again.
    """

    name: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The three base kinds.
_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12)
ACCESS = Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18)
HEX = Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16)  # runs are maximal, so shorter ones need no match
BASE_RULES = (ASSIGN, ACCESS, HEX)
#: Further kinds: private key blocks, code-host and chat tokens, passwords inside addresses.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("host_token", 1, r"gh[opsur]_[A-Za-z0-9]+", 0, 40),
    Rule("chat_token", 1, r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("url_login", 1, r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]+@", 0, 1),
)
RULES = BASE_RULES + MORE_RULES

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


#: Elements that one fold collects. A fold copies what it has collected with every element, so a
#: long array is folded in blocks, and what the blocks come to in a fold of its own.
BLOCK = 512


def _blocks(values: Column) -> Column:
    """An array cut into arrays of :data:`BLOCK` elements; none from none."""
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(BLOCK))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.slice(values, i, F.lit(BLOCK)))


def running(values: Column, first: Column, step, total) -> Column:
    """For each of the integers in ``values`` what ``step`` has made of ``first`` and those before it.

    ``total`` is what ``step`` makes of a whole array, as a function of it.
    """

    def fold(own: Column, start: Column) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))

        def add(state: Column, value: Column) -> Column:
            return F.struct(
                step(state["at"], value).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out")
            )

        return F.aggregate(own, empty, add, lambda state: state["out"])

    def joined(blocks: Column) -> Column:
        return F.flatten(F.zip_with(blocks, fold(F.transform(blocks, total), first), fold))

    return let(_blocks(values), joined)


def running_sum(values: Column, first: Column) -> Column:
    return running(values, first, lambda a, x: a + x, lambda own: F.aggregate(own, F.lit(0), lambda a, x: a + x))


def running_max(values: Column, first: Column) -> Column:
    return running(values, first, F.greatest, F.array_max)


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule's matches, in code points, end exclusive.

    Matches and the pieces between them give the positions; texts without a match stop at one probe.
    """
    pattern = F.lit(rule.pattern)

    def located(parts: Column) -> Column:
        steps = F.zip_with(
            parts["matches"], F.slice(parts["pieces"], F.lit(1), F.size(parts["matches"])),
            lambda match, piece: F.length(piece) + F.length(match),
        )
        # where each match ends: the lengths up to it, its own included
        ends = let(steps, lambda own: F.zip_with(running_sum(own, F.lit(0)), own, lambda before, length: before + length))
        return F.zip_with(parts["matches"], ends, span)

    def span(match: Column, end: Column) -> Column:
        judged = match if rule.group == 0 else F.regexp_extract(match, rule.pattern, rule.group)
        found = F.struct(
            (end - F.length(match)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.name).alias("kind")
        )
        return F.when(F.length(judged) >= rule.least, found)

    parts = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("matches"), F.split(text, rule.pattern, -1).alias("pieces")
    )
    spans = F.filter(let(parts, located), lambda s: s.isNotNull()).cast(SPAN)
    return F.when(F.regexp_like(text, pattern), spans).otherwise(F.array().cast(SPAN))


def _content(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def address(text: str = "text") -> Column:
    """Content address of a text; null is the empty text."""
    return F.sha2(_content(text), 256)


def _scans(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(f"blob string, rules array<string>, spans {SPAN}").parquet(ledger)


def open_ledger(spark: SparkSession, ledger: str) -> None:
    """Create the ledger if there is none yet."""
    empty = spark.createDataFrame([], f"blob string, rules array<string>, spans {SPAN}")
    empty.write.mode("ignore").parquet(ledger)


def scan_unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger lacks and append it: one copy of each blob, with its unseen rules only.

    ``versions`` has ``path`` and ``text``, a row per version. A blob is read from its version with
    the least path, so that however many copies there are, the join has one key per path.
    """
    spark = versions.sparkSession
    addressed = versions.select("path", _content().alias("text")).withColumn("blob", address())
    blobs = addressed.groupBy("blob").agg(F.min("path").alias("path"))
    known = _scans(spark, ledger).select("blob", F.explode("rules").alias("rule"))
    known = known.groupBy("blob").agg(F.collect_set("rule").alias("rules"))
    all_rules = F.array(*(F.lit(rule.key) for rule in rules))
    due = F.array_except(all_rules, F.coalesce("rules", F.array().cast("array<string>")))
    todo = materialize(
        blobs.join(known, "blob", "left").select("blob", "path", due.alias("due")).filter(F.size("due") > 0)
    )
    match = (addressed.blob == todo.blob) & addressed.path.eqNullSafe(todo.path)
    texts = addressed.join(todo.hint("shuffle_hash"), match).select(todo.blob, "due", "text")
    found = F.concat(
        *(
            F.when(F.array_contains("due", rule.key), rule_spans(F.col("text"), rule, rank)).otherwise(
                F.array().cast(SPAN)
            )
            for rank, rule in enumerate(rules)
        )
    )
    texts.select("blob", F.col("due").alias("rules"), found.alias("spans")).write.mode("append").parquet(ledger)


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, spans`` of the blobs in which the rules found something, in order of start and rule.

    What other versions of a rule found does not count.
    """
    keys = F.create_map(*(F.lit(x) for rule in rules for x in (rule.name, rule.key)))
    scans = _scans(spark, ledger).filter(F.size("spans") > 0)
    spans = scans.select("blob", "rules", F.explode("spans").alias("span"))
    spans = spans.filter(F.array_contains("rules", F.try_element_at(keys, "span.kind")))
    return spans.groupBy("blob").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def secrets(
    versions: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``path, blob, spans`` for every version: all rows of ``versions`` (``path, text``).

    ``ledger`` is a folder that later runs continue; without one a fresh ledger is kept in the
    scratch folder. Null and empty texts have no spans. Rows without a path and repeated rows each
    keep a row; further columns are ignored; an empty table gives no rows. Blobs that many paths
    share meet their findings in a join that adaptive execution splits.
    """
    spark = versions.sparkSession
    ledger = ledger or scratch_dir(spark)
    open_ledger(spark, ledger)
    scan_unseen(versions, ledger, rules)
    found = materialize(findings(spark, ledger, rules))
    addressed = versions.select("path", address().alias("blob"))
    return addressed.join(found, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")
    )


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def cut(text: Column, pieces: Column) -> Column:
    """The texts of ``pieces``, ascending structs of ``start`` and ``end`` that do not overlap.

    Finding a place in a text takes a walk to it, so pieces are cut out of the stretch that their block covers.
    """

    def of(block: Column) -> Column:
        first = block[0]["start"]
        stretch = F.substring(text, first + 1, F.element_at(block, -1)["end"] - first)
        return let(stretch, lambda short: F.transform(
            block, lambda p: F.substring(short, p["start"] - first + 1, p["end"] - p["start"])
        ))

    return F.flatten(F.transform(_blocks(pieces), of))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind."""

    def replaced(own: Column) -> Column:
        # the furthest end of the spans before each: one that starts there or later begins a run
        reached = running_max(F.transform(own, lambda s: s["end"]), F.lit(0))
        opens = F.zip_with(own, reached, lambda s, at: F.when(
            s["start"] >= at, F.struct(at.alias("start"), s["start"].alias("end"), s["kind"].alias("kind"))
        ))
        return let(F.filter(opens, lambda p: p.isNotNull()), lambda gaps: filled(gaps, own))

    def filled(gaps: Column, own: Column) -> Column:
        kept = F.zip_with(cut(text, gaps), gaps, lambda gap, p: F.concat(gap, F.lit("["), p["kind"], F.lit("]")))
        rest = F.substring(text, F.array_max(F.transform(own, lambda s: s["end"])) + 1, F.length(text))
        return F.concat(F.array_join(kept, ""), rest)

    return F.when(F.size(spans) > 0, let(spans, replaced)).otherwise(text)


def redact_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All documents with all their columns; secrets in ``text`` give way to ``[kind]``.

    ``n_chars``, if there, counts the new text of changed rows. Rows without secrets, null texts
    among them, come back as they are.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch_dir(spark)
    open_ledger(spark, ledger)
    scan_unseen(docs.select(F.col("doc_id").alias("path"), "text"), ledger, rules)
    blob, spans, new = (pick_name(docs, name) for name in ("blob", "spans", "redacted"))
    found = materialize(findings(spark, ledger, rules).select(F.col("blob").alias(blob), F.col("spans").alias(spans)))
    joined = docs.withColumn(blob, address()).join(found, blob, "left")
    changed = F.col(spans).isNotNull()
    joined = joined.withColumn(new, F.when(changed, redacted(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    out = {c: F.col(c) for c in docs.columns}
    out["text"] = F.col(new)
    if "n_chars" in out:
        length = F.length(new).cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(changed, length).otherwise(F.col("n_chars"))
    return joined.select(*(value.alias(name) for name, value in out.items()))
