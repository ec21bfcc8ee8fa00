"""Personal data in text: base patterns, and further spans found by weak supervision.

Regex, checksum, gazetteer and context labelers vote on every candidate span (the base spans take part, so that reliabilities are
learnt from clear cases too). Votes are counted by pattern, expectation-maximisation estimates each labeler's reliability per family
of candidates, and a logistic span classifier is trained on the posteriors with the span's shape as further features. Candidates it
accepts are added to the base spans. The tables that reach the driver have one row per pattern of votes and shape, a fixed number.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.once import with_columns_once
from quipu.llm.columns import kept_apart
from quipu.llm.common import bound, ranked, span_text, spans, stored, whole_text
from quipu.llm.weak import fit_logistic, fit_voters

# The base kinds, their patterns and their order.
KINDS = ["email", "ip", "card", "phone"]
# Written so that no start inside a run is tried again; the matches are those of the plain patterns.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

# Candidates of the added kinds, by family.
NUMBER = r"(?<![0-9])[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"
_HOST = r"(?: at | ?\(at\) ?| ?\[at\] ?)[a-z0-9-]++"
_DOT = r"(?: dot | ?\(dot\) ?| ?\[dot\] ?|\.)"
SPOKEN = rf"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++{_HOST}(?:{_DOT}[a-z0-9-]++)++"
# The end of every spoken address, up to its first dot.
SPOKEN_SIGN = rf"(?i){_HOST}{_DOT}[a-z0-9-]"
# Gazetteers and context words, fixed values.
FIRST_NAMES = (
    "James John Robert Michael William David Richard Joseph Thomas Mary Patricia Jennifer Linda Elizabeth Barbara Susan Sarah Karen "
    "Hans Peter Klaus Anna Ursula Monika Jean Pierre Marie Michel Nathalie Sophie Juan Carlos Maria Carmen Antonio Francisco"
).split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame".split()
NAME = rf"(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.? |(?:{'|'.join(FIRST_NAMES)}) )\p{{Lu}}\p{{Ll}}++(?: \p{{Lu}}\p{{Ll}}++)?"
ENDINGS = "com org net edu gov io de fr es uk eu info".split()
CUES = (
    r"\b(?:tel|phone|call|fax|mobile|cell|card|visa|account|ssn|iban|passport|contact|mail|email|name|dear|carte|karte|tarjeta|konto|cuenta|compte|"
    r"telefon|teléfono|téléphone)\b[^\p{L}]*$"
)
COUNTER_CUES = r"(?:\b(?:version|v|no|nr|page|isbn|order|invoice|chapter|license|licence|section|figure|table|rev)\b\.?|[$€£§#])\s*$"
ISSUERS = r"^(?:4|5[1-5]|3[47]|6011|65|35)"
CONTEXT = 24

FAMILIES = ["number", "contact", "name"]
VOTES = ["v_shape", "v_check", "v_gazetteer", "v_cue", "v_counter"]
SHAPE = ["length", "joint"]
PRIOR = 0.5
ACCEPT = 0.5


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def total(d: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(d))
        value = lambda i: F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.aggregate(F.transform(places, value), F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))

    return F.when(F.length(digits) > 0, bound(digits, total) % 10 == 0).otherwise(False)


def base_spans(text: Column) -> dict[str, Column]:
    """Base spans by kind; matches that fail their kind's test are dropped, not retried."""
    count = lambda s: F.length(_digits(s["hit"]))
    return {
        "email": spans(text, EMAIL, text.contains("@")),
        "ip": F.filter(spans(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda s: s["hit"].rlike(OCTETS)),
        "card": F.filter(spans(text, CARD), lambda s: (count(s) <= 19) & luhn(_digits(s["hit"]))),
        "phone": F.filter(spans(text, PHONE, text.contains("+")), lambda s: count(s).between(9, 15)),
    }


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def _voted(found: Column, text: Column, family: str, base: bool) -> Column:
    """Candidates with the labelers' votes and their shape."""
    no = F.lit(False)

    def look(s: Column) -> Column:
        hit, digits, n = s["hit"], _digits(s["hit"]), F.length(_digits(s["hit"]))
        before = F.lower(F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))))
        if family == "number":
            shapes = r"^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|(?:[0-9]{4}[ -]?){3}[0-9]{4})$"
            shape = _vote(hit.rlike(shapes) | hit.startswith("+") | hit.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), hit.rlike(r"^[0-9]{4}[.-][0-9]{2}[.-][0-9]{2}"))
            check = F.when(n.between(12, 19), F.when(luhn(digits), 1).otherwise(-1)).otherwise(0)
            known = _vote(n.between(13, 16) & digits.rlike(ISSUERS), digits.rlike(r"^(.)\1+$"))
        elif family == "contact":
            ending = F.lower(F.regexp_extract(hit, r"([A-Za-z0-9-]+)$", 1))
            shape = _vote(hit.contains("@") | hit.rlike(r"(?i)[(\[]at[)\]]"), no)
            check, known = F.lit(0), _vote(ending.isin(ENDINGS), ~ending.rlike("^[a-z]{2,6}$"))
        else:
            shape, check = _vote(hit.rlike(r"\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+$"), no), F.lit(0)
            known = _vote(F.split(hit, r"\.? ", 2)[0].isin(FIRST_NAMES + TITLES), no)
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(FAMILIES.index(family)).alias("family"), F.lit(base).alias("base"),
            shape.alias("v_shape"), check.alias("v_check"), known.alias("v_gazetteer"),
            _vote(before.rlike(CUES), no).alias("v_cue"), _vote(no, before.rlike(COUNTER_CUES)).alias("v_counter"),
            F.when(n < 9, 0).when(n < 12, 1).when(n < 16, 2).when(n == 16, 3).otherwise(4).alias("length"),
            F.when(hit.rlike(r"[.()]"), 2).when(hit.rlike(r"[ -]"), 1).otherwise(0).alias("joint"),
        )

    return F.transform(found, look)


def _features(row) -> tuple[float, ...]:
    """One-hot features of a pattern: family, votes for and against, length and joint."""
    out = [float(row["family"] == k) for k in range(1, len(FAMILIES))]
    for v in VOTES:
        out += [float(row[v] == 1), float(row[v] == -1)]
    out += [float(row["length"] == k) for k in range(1, 5)]
    return tuple(out + [float(row["joint"] == k) for k in (1, 2)])


def train(candidates: DataFrame) -> list[float]:
    """Weights of the span classifier, from an array column ``candidates``. No candidates: a classifier that accepts nothing."""
    names = ["family", *VOTES, *SHAPE]
    rows = candidates.select(F.inline("candidates")).groupBy(*names).agg(F.count("*").alias("n")).collect()
    fitted = []
    for family in range(len(FAMILIES)):
        own = [r for r in rows if r["family"] == family]
        counts: dict[tuple[int, ...], int] = {}
        for r in own:
            votes = tuple(r[v] for v in VOTES)
            counts[votes] = counts.get(votes, 0) + r["n"]
        model = fit_voters(counts, PRIOR)
        fitted += [(_features(r), model.posterior(tuple(r[v] for v in VOTES)), r["n"]) for r in own]
    return fit_logistic(sorted(fitted)) if fitted else [-20.0]


def probability(s: Column, weights: list[float]) -> Column:
    """The classifier as an expression over a candidate."""
    z = F.lit(float(weights[-1]))
    tests = [s["family"] == k for k in range(1, len(FAMILIES))]
    for v in VOTES:
        tests += [s[v] == 1, s[v] == -1]
    tests += [s["length"] == k for k in range(1, 5)] + [s["joint"] == k for k in (1, 2)]
    for test, w in zip(tests, weights[:-1], strict=False):
        z = z + F.when(test, float(w)).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without their text, with base (array of start, rank, kind, end), added (the same, by the classifier).

    Places are code points, end exclusive. A null or empty text has no spans; repeated rows get equal spans; an empty table gives an
    empty result. Added spans never overlap base ones. Other columns stay; one named like a result comes back as <name>_before.
    """
    return kept_apart(docs, [text], lambda rows: _found(rows, text))


def _found(docs: DataFrame, text: str) -> DataFrame:
    rows = with_columns_once(docs, {"__text": whole_text(text)})
    rows = with_columns_once(rows, base_spans(F.col("__text")))
    t = F.col("__text")
    rows = with_columns_once(
        rows,
        {
            "base": F.concat(*[ranked(F.col(k), k, i) for i, k in enumerate(KINDS)]),
            "__number": spans(t, NUMBER),
            "__spoken": spans(t, SPOKEN, t.rlike(SPOKEN_SIGN)),
            "__name": spans(t, NAME),
        },
    )
    free = lambda found: F.filter(found, lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    candidates = F.concat(
        _voted(F.col("email"), t, "contact", True), _voted(F.concat("card", "phone", "ip"), t, "number", True),
        _voted(free(F.col("__number")), t, "number", False), _voted(free(F.col("__spoken")), t, "contact", False),
        _voted(free(F.col("__name")), t, "name", False),
    )
    counts = {f"n_{k}": F.size(k).cast("long") for k in KINDS}
    rows = with_columns_once(rows, {"candidates": candidates}).withColumns(counts)
    rows = stored(rows.drop("__text", "__number", "__spoken", "__name", *KINDS, text), "pii-candidates")
    weights = train(rows)
    # A number that fails its checksum is no card, however much it looks like one.
    accepted = F.filter("candidates", lambda s: ~s["base"] & (s["v_check"] >= 0) & (probability(s, weights) >= ACCEPT))
    kind = lambda s: F.get(F.array(*[F.lit(f) for f in FAMILIES]), s["family"])
    added = F.transform(
        accepted,
        lambda s: F.struct(s["start"].alias("start"), (s["family"] + len(KINDS)).alias("rank"), kind(s).alias("kind"), s["end"].alias("end")),
    )
    return rows.withColumn("added", added).drop("candidates")


def digest(found: DataFrame) -> DataFrame:
    return found.withColumns({"base_sha256": F.sha2(span_text(F.col("base")), 256), "spans": span_text(F.concat("base", "added"))}).drop("base", "added")
