"""Toxic passages as maximum-scoring segments.

Tokens score their log-odds between toxic and clean texts under a Dirichlet prior, from labelled rows; tokens without evidence score a
fixed drift below zero. A linear scan finds every maximal scoring segment of a text; extreme-value statistics turn a segment's score
into the number of such segments that a clean text of this length would show by chance. Their evidence is summed over the text's
significant segments and calibrated to a probability on labelled rows that the lexicon hasn't seen.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import lean, map_batches, text_batches, whole_text, with_package

#: Labelled rows that the lexicon and the calibration see at most, together.
TRAIN_ROWS = 15_000
#: The prior weighs as much as this share of the texts.
PRIOR_SHARE = 0.1
MIN_TEXTS = 3
#: Least score, an odds ratio of about 7: words that merely lean to toxic texts, as a language's own may, say nothing.
MIN_SCORE = 2.0
DRIFT = 0.25
MAX_SCORE = 8.0
REJECT = 0.7
CACHE = 100_000
#: Counts that a task of the training holds before it hands them on.
COUNTED = 50_000

# ASCII letters in lower case; other ASCII signs separate tokens, and so do digits.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


#: Besides itself a token counts as its beginnings of so many bytes, which stand for its stem.
STEMS = (4, 5, 6, 7)


def forms(token: bytes) -> list[bytes]:
    return [token, *[token[:k] + b"*" for k in STEMS if len(token) > k]]


def tokens(text: str) -> list[bytes]:
    """Words of a text: lower case, ASCII punctuation and digits separate."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()


def segments(scored: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence whose places in ``scored`` have those scores above 0 and all
    others -drift, by the linear-time stack method; places ascend."""
    stack: list[tuple[int, int, float, float]] = []  # first, last, sum before it, sum at its end
    total, at = 0.0, 0
    for place, score in scored:
        total -= drift * (place - at)
        left, right, first = total, total + score, place
        total, at = right, place + 1
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= left:
                k -= 1
            if k < 0 or stack[k][3] >= right:
                stack.append((first, place, left, right))
                break
            first, left = stack[k][0], stack[k][2]
            del stack[k:]
    return [(a, b, r - x) for a, b, x, r in stack]


def scored_places(words: list[bytes], lexicon: dict[bytes, float], seen: dict[bytes, float]) -> list[tuple[int, float]]:
    """(place, score) of the words with a score: the best of their forms'. seen: a cache of word scores, cleared when it is large."""
    if len(seen) > CACHE:
        seen.clear()
    for w in set(words).difference(seen):
        seen[w] = max((lexicon.get(f, 0.0) for f in forms(w)), default=0.0)
    return [(i, s) for i, s in enumerate(map(seen.__getitem__, words)) if s]


@dataclass(frozen=True)
class Model:
    """lexicon: scores above 0; scale, constant: of the extreme-value law of chance segments; bias, slope: of the calibration."""

    lexicon: dict[bytes, float]
    scale: float = 1.0
    constant: float = 1.0
    bias: float = -5.0
    slope: float = 0.0
    drift: float = DRIFT
    #: Scores of the words met so far by this copy of the model.
    seen: dict[bytes, float] = field(default_factory=dict, compare=False)

    def passages(self, text: str) -> list[tuple[int, int, float, float]]:
        """(first word, last word, score, expected number by chance) of the significant segments: expected less than once."""
        words = tokens(text)
        scored = scored_places(words, self.lexicon, self.seen)
        return self.significant(segments(scored, self.drift), len(words)) if scored else []

    def significant(self, parts: list[tuple[int, int, float]], words: int) -> list[tuple[int, int, float, float]]:
        chances = ((a, b, s, self.constant * words * math.exp(-self.scale * s)) for a, b, s in parts)
        return [c for c in chances if c[3] < 1]

    def evidence(self, found: list[tuple[int, int, float, float]]) -> float:
        return math.log1p(sum(-math.log(max(c, 1e-300)) for *_, c in found))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.bias + self.slope * evidence))))


def least_z(texts: int) -> float:
    """The z that a token needs: more texts bring more tokens that might be in toxic ones by chance."""
    return 2.0 + 0.6 * math.log10(max(1.0, texts / 300))


def log_odds(toxic: dict[bytes, int], clean: dict[bytes, int], n_toxic: int, n_clean: int) -> dict[bytes, float]:
    """Scores of tokens with enough toxic texts and a high enough z: log-odds less a standard error. Counts are of texts that have the token; the prior is their
    share of all texts, with the weight of PRIOR_SHARE of them."""
    out, texts = {}, n_toxic + n_clean
    weight = max(1.0, PRIOR_SHARE * texts)
    for w, y in toxic.items():
        if y < MIN_TEXTS:
            continue
        x = clean.get(w, 0)
        prior = weight * min(0.999, (x + y) / texts)
        a = (y + prior) / max(n_toxic + weight - y - prior, 0.5)
        b = (x + prior) / max(n_clean + weight - x - prior, 0.5)
        delta = math.log(a / b)
        doubt = math.sqrt(1 / (y + prior) + 1 / (x + prior))
        if delta - doubt >= MIN_SCORE and delta >= least_z(texts) * doubt:
            out[w] = min(delta - doubt, MAX_SCORE)
    return out


def _chance_law(background: Counter, words: int, drift: float) -> tuple[float, float]:
    """scale and constant of the law of segments among clean words: the scale solves E[exp(scale * score)] = 1; the constant
    comes from single hits. background: clean words of the calibration rows by score."""
    shares = {s: (n + 0.5) / (words + 1) for s, n in background.items()}
    rest = max(1e-9, 1 - sum(shares.values()))
    mean = lambda t: rest * math.exp(-drift * t) + sum(p * math.exp(s * t) for s, p in shares.items())
    lo, hi = 1e-3, 1e-3
    while mean(hi) < 1 and hi < 50:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    scale = max(lo, 0.05)
    least = min(shares, default=1.0)
    return scale, sum(shares.values()) * math.exp(scale * least) if shares else 1e-6


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """bias and slope of a logistic model, by Newton steps with a small penalty; targets are smoothed against perfect splits."""
    ones = max(1, int(y.sum()))
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    w = np.zeros(2)
    a = np.column_stack([np.ones(len(x)), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (target - p) - 1e-3 * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(max(w[1], 0.0))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int) -> DataFrame:
    """doc_id, text, label of at most about ``rows`` labelled rows, by a hash of their id; labels of one id that differ are left out."""
    marks = labels.select("doc_id", F.col(label).alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL").filter(allowed)
    marks = marks.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("__hi")).filter("label = __hi").drop("__hi")
    share = min(1.0, rows / max(1, marks.count()))
    marks = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return docs.select("doc_id", whole_text().alias("text")).join(marks, "doc_id")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Model from the labelled rows that aren't held out; the same rows give the same model. For the calibration, the texts of each half of their ids are scored by the
    lexicon of the other half. Without toxic or without clean rows nothing is learnt and every score is low."""
    sample = labelled_sample(docs, labels, "toxic", ~held_out(F.col("doc_id")), rows)
    sample = sample.withColumn("half", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0).cast("int"))

    def counted(seen: Counter) -> pd.DataFrame:
        return pd.DataFrame([(w, k, n) for (w, k), n in seen.items()], columns=["token", "kind", "n"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text, label, half in zip(batch["text"], batch["label"], batch["half"], strict=True):
                kind = int(2 * half + label)
                seen.update((w, kind) for w in {b"", *(f for t in set(tokens(text)) for f in forms(t))})
                if len(seen) >= COUNTED:
                    yield counted(seen)
                    seen.clear()
        yield counted(seen)

    # Equal texts count once, with the half of the smallest id; if their labels differ, not at all.
    label = F.col("label").cast("int")
    different = sample.groupBy("text").agg(F.min(label).alias("label"), F.max(label).alias("__hi"), F.min_by("half", "doc_id").alias("half"))
    different = different.filter("label = __hi").drop("__hi")
    counts = with_package(different).mapInPandas(lean(count), "token binary, kind int, n long")
    kinds = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)) for k in range(4)]
    totals = counts.groupBy("token").agg(F.array(*kinds).alias("n"))
    # The empty token counts texts. Tokens too rare for any lexicon stay where they are.
    with text_batches(docs.sparkSession):
        found = totals.filter((F.col("n")[1] + F.col("n")[3] >= MIN_TEXTS) | (F.octet_length("token") == 0)).collect()
    by = {bytes(r["token"]): list(r["n"]) for r in found}
    texts = by.pop(b"", [0, 0, 0, 0])
    if not texts[1] + texts[3] or not texts[0] + texts[2]:
        return Model({})
    half = lambda h: log_odds({w: n[2 * h + 1] for w, n in by.items()}, {w: n[2 * h] for w, n in by.items()}, texts[2 * h + 1], texts[2 * h])
    lexicon = log_odds({w: n[1] + n[3] for w, n in by.items()}, {w: n[0] + n[2] for w, n in by.items()}, texts[1] + texts[3], texts[0] + texts[2])
    others = [half(1), half(0)]

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        caches: list[dict[bytes, float]] = [{}, {}]
        for batch in batches:
            out = []
            for text, label, own in zip(batch["text"], batch["label"], batch["half"], strict=True):
                words = tokens(text)
                found = scored_places(words, others[own], caches[own])
                out.append((label, len(words), [i for i, _ in found], [x for _, x in found]))
            yield pd.DataFrame(out, columns=["label", "n", "places", "scores"])

    with text_batches(docs.sparkSession):
        rest = with_package(different).mapInPandas(lean(hits), "label int, n long, places array<int>, scores array<double>").collect()
    background: Counter = Counter(s for r in rest if r["label"] == 0 for s in r["scores"])
    scale, constant = _chance_law(background, sum(r["n"] for r in rest if r["label"] == 0), DRIFT)
    model = Model(lexicon, scale, constant)
    evidence = []
    for r in rest:
        parts = segments(list(zip(r["places"], r["scores"], strict=True)), DRIFT)
        evidence.append(model.evidence(model.significant(parts, r["n"])))
    bias, slope = _calibrated(np.asarray(evidence), np.asarray([r["label"] for r in rest]))
    return Model(lexicon, scale, constant, bias, slope)


PASSAGES = "array<struct<first:int,last:int,score:double,chance:double>>"


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """docs with toxicity (0 to 1) and passages: words first to last, score and expected number by chance.

    A null or empty text has no passage and the lowest score. Extra columns stay; columns named like the new ones are replaced;
    equal texts score equally; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("toxicity", "passages")]

    def score(texts: list[str | None]) -> dict:
        found = [model.passages(t or "") for t in texts]
        return {
            "toxicity": [model.score(model.evidence(f)) for f in found],
            "passages": [[dict(zip(("first", "last", "score", "chance"), p, strict=True)) for p in f] for f in found],
        }

    return map_batches(docs, ["text"], kept, f"toxicity double, passages {PASSAGES}", score)
