"""Secrets in every historical version of a text, by an incremental ledger of blobs.

A version's content address is the SHA-256 of its text. The ledger holds the findings of every (blob, rule, rule version) that was
ever scanned; a run scans only pairs it doesn't hold, each blob once however many paths carry it, appends them, and joins findings
back to all paths.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.once import with_columns_once
from quipu.llm.columns import kept_apart
from quipu.llm.common import bound, no_rows, ranked, small_side, span_text, spans, stored, whole_text
from quipu.scratch import run_folder


@dataclass(frozen=True)
class Rule:
    """pattern: what to search; sign: texts without it are not searched; check: of the match, whether it counts."""

    name: str
    version: int
    pattern: str
    sign: str
    check: str = ""

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


_KEYWORD = r"(?i:password|passwd|secret|token|api_?key)"
_VALUE = "[A-Za-z0-9+/_.=-]"
_GLUE = r"[\"']?\x20*[:=]\x20*[\"']?"
# A key in armour, from its BEGIN line to its END line. Where that is missing: its headers and base64 lines, and long base64 runs
# that share a line with other text. Line ends may be written as escapes.
_KIND = r"(?:(?!PRIVATE KEY)[A-Z0-9 ])*+PRIVATE KEY(?: BLOCK)?-----"
_BREAK = r"(?:\s|\\[nrt])++"
_HEADERS = rf"(?:{_BREAK}(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\r\n\\]*+)*+"
_LINES = rf"(?:{_BREAK}(?:[A-Za-z0-9+/=]{{20,}}+|[A-Za-z0-9+/=]++(?=[\x20\t]*+(?:[\r\n]|\\[nr]|\z))))*+"
_KEY = rf"-----BEGIN {_KIND}(?:(?:(?!-----)[\s\S])*+-----END {_KIND}|{_HEADERS}{_LINES})"
# The base kinds and their order.
BASE = ["assign", "access", "hex"]
RULES = [
    Rule("assign", 1, f"{_KEYWORD}{_GLUE}{_VALUE}+", "[:=]", f"^{_KEYWORD}{_GLUE}{_VALUE}{{8,}}$"),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}+", "AKIA"),
    Rule("hex", 1, "(?<![0-9a-f])[0-9a-f]{32,}+", "[0-9a-f]{32}"),
    Rule("private_key", 2, _KEY, "PRIVATE KEY"),
    Rule("bearer", 1, r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "eyJ"),
    Rule("forge", 1, r"(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+)", "(?:gh[pousr]_|xox[abprs]-)"),
    Rule("address", 2, r"[a-z][a-z0-9+.-]{1,20}://[^/\s:@]*+:[^/\s:@]++@", "://"),
]
MASK = "[SECRET]"
_FINDING = "struct<start:int,rank:int,kind:string,end:int>"


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    plain = not any(c in rule.sign for c in "[(")
    found = spans(text, rule.pattern, text.contains(rule.sign) if plain else text.rlike(rule.sign))
    if rule.check:
        found = F.filter(found, lambda s: s["hit"].rlike(rule.check))
    return ranked(found, rule.name, rank)


def scan(versions: DataFrame, ledger: str | None = None, rules: list[Rule] = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
    """versions without their text, with blob (binary) and findings (array of start, rank, kind, end; code points, end exclusive).

    ledger: a folder that earlier runs of any rules share; None: a new one, so everything is unseen. A null or empty text is the
    empty blob. Equal texts are one blob, repeated rows and null paths included; an empty table gives an empty result. A run that
    fails part-way appends nothing; two runs may append the same pair, which is read once. Other columns stay; one named like a result
    comes back as <name>_before.
    """
    return kept_apart(versions, [path, text], lambda rows: _scanned(rows, ledger, rules, path, text))


def _scanned(versions: DataFrame, ledger: str | None, rules: list[Rule], path: str, text: str) -> DataFrame:
    spark = versions.sparkSession
    folder = ledger or run_folder(spark, "secret-ledger")
    no_rows(spark, f"blob binary, rule string, findings array<{_FINDING}>").write.mode("append").parquet(folder)
    known = spark.read.parquet(folder)
    keyed = with_columns_once(versions, {"__text": whole_text(text)})
    keyed = with_columns_once(keyed, {"blob": F.unhex(F.sha2(F.col("__text"), 256))})
    paths = stored(keyed.drop("__text", text), "secret-paths")

    wanted = F.array(*[F.lit(r.key) for r in rules])
    seen = known.groupBy("blob").agg(F.collect_set("rule").alias("__seen"))
    blobs = paths.groupBy("blob").agg(F.min(path).alias("__first"), F.count("*").alias("__paths"))
    blobs = blobs.join(seen, "blob", "left").withColumn("__missing", F.array_except(wanted, F.coalesce("__seen", F.array().cast("array<string>"))))
    # Blobs on one path and never scanned need no entry: what is left out is scanned whole.
    special = stored(blobs.filter((F.col("__paths") > 1) | F.col("__seen").isNotNull()).select("blob", "__first", "__missing"), "secret-repeats")
    texts = keyed.select(F.col(path).alias("__path"), "blob", "__text").join(small_side(special), "blob", "left")
    alone = F.col("__missing").isNull()
    chosen = alone | ((F.size("__missing") > 0) & F.col("__path").eqNullSafe(F.col("__first")))
    missing = F.coalesce("__missing", wanted)
    texts = texts.filter(chosen)
    none = F.array().cast(f"array<{_FINDING}>")
    scanned = F.array(
        *[
            F.struct(F.lit(r.key).alias("rule"), F.when(F.array_contains(missing, r.key), _matches(F.col("__text"), r, i)).alias("findings"))
            for i, r in enumerate(rules)
        ]
    )
    fresh = texts.select("blob", F.inline(scanned)).filter(F.col("findings").isNotNull())
    fresh.withColumn("findings", F.col("findings").cast(f"array<{_FINDING}>")).write.mode("append").parquet(folder)

    keys = [r.key for r in rules]
    found = spark.read.parquet(folder).filter(F.col("rule").isin(keys) & (F.size("findings") > 0)).dropDuplicates(["blob", "rule"])
    found = found.groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings"))
    return paths.join(found, "blob", "left").withColumn("findings", F.coalesce("findings", none))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans."""
    base = F.filter("findings", lambda s: s["rank"] < len(BASE))
    of = lambda k: F.size(F.filter("findings", lambda s: s["kind"] == k)).cast("long")
    return found.withColumns(
        {f"n_{k}": of(k) for k in BASE} | {"base_sha256": F.sha2(span_text(base), 256), "spans": span_text(F.col("findings"))}
    ).drop("findings", "blob")


def masked(text: Column, findings: Column, mask: str = MASK) -> Column:
    """The text with every finding replaced; overlapping findings become one mask."""

    def merge(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))),
        )
        apart = F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))
        return F.when((F.size(done) > 0) & (s["start"] < last["end"]), joined).otherwise(apart)

    def cut(parts: Column) -> Column:
        before = lambda i: F.coalesce(F.get(parts, i - 1)["end"], F.lit(0))
        kept = F.transform(parts, lambda s, i: F.concat(F.substring(text, before(i) + 1, s["start"] - before(i)), F.lit(mask)))
        end = F.get(parts, F.size(parts) - 1)["end"]
        return F.concat(F.concat_ws("", kept), F.substring(text, end + 1, F.length(text)))

    spans_ = F.aggregate(F.sort_array(findings), F.array().cast("array<struct<start:int,end:int>>"), merge)
    return F.when(F.size(findings) > 0, bound(spans_, cut)).otherwise(text)
