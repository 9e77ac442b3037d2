"""Quality classifier from weak labels.

Heuristic labelers vote on every document (good, bad or neither), and so does the table
of human labels where it has an opinion.  Expectation-maximisation estimates from the
counts of vote patterns over all documents how accurate each labeler is; the number of
patterns is bounded by the labelers.  The posterior labels then train a hashed linear
scorer, one head for low quality and one for toxic text, on at most ``TRAIN_ROWS``
documents chosen by a hash; every document is scored over its whole text.

Defined results: a null or blank text has the low-quality probability one and is rejected;
repeated or contradictory labels count as their mean, a tie as bad; labels with a null id
count for nothing; without labels the heuristics alone decide; documents that repeat each
give a row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import compress, starmap
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import drop_held, shielded, staged

TRAIN_ROWS = 8192
LABELLED_SHARE = 0.75
DIMENSIONS = 1 << 18
REJECTED = 0.5
LEAST_DOCUMENTS = 3
# Of both heads, low quality and toxic.
EPOCHS = (6, 12)
RATES = (0.3, 1.0)
LEAST_DEVIATIONS = (0.0, 5.0)
POSITIVE_WEIGHTS = (1.0, 5.0)
_PER_WORD = 4
_WEIGHTS_KEPT = 150_000
_TEXTS = 512
_DRAW = 1 << 30

# Frequent short words of the four languages, and insults.
STOP_WORDS = frozenset(
    "the of and to in is it for on was with that by this are be as at from or an a "
    "de la le et les des en un une que pour dans est du au "
    "der die das und in den von zu mit sich auf ist im ein eine "
    "el los las y del se por con para es una su al lo".split()
)
INSULTS = frozenset("clown disgusting idiot loser moron pathetic scum stupid trash worthless".split())


# ---- labelers ----------------------------------------------------------------------------


def _three(value: float, good: float, bad: float) -> str:
    """'1' (bad) from ``bad`` on, '0' (good) up to ``good``, '-' between; the other way if good > bad."""
    if good <= bad:
        return "1" if value >= bad else "0" if value <= good else "-"
    return "1" if value <= bad else "0" if value >= good else "-"


_LOWER = re.compile(r"[a-zß-öø-ÿ]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SIGNS = re.compile(r"[#$%&*=<>{}\\^~|@!]")
QUALITY_LABELERS = ("capitals", "signs", "bars", "variety", "stutter", "stop_words")
TOXIC_LABELERS = ("insults",)


def _variety(words: list[str]) -> float:
    """The share of distinct words in blocks of a hundred, so that long texts do not look monotonous."""
    return sum(len(set(words[i : i + 100])) for i in range(0, len(words), 100)) / len(words)


def votes(text: str) -> str:
    """One sign per labeler."""
    words = text.split()
    n = len(words)
    if not n:
        return "-" * (len(QUALITY_LABELERS) + len(TOXIC_LABELERS))
    upper = len(_UPPER.findall(text))
    lower = len(_LOWER.findall(text))
    plain = [w.strip(".,;:!?()\"'").lower() for w in words]
    out = [
        _three(upper / max(1, upper + lower), 0.15, 0.4),
        _three(len(_SIGNS.findall(text)) / n, 0.05, 0.3),
        _three(text.count("|") / n, 0.02, 0.2),
        _three(_variety(plain), 0.45, 0.25) if n >= 40 else "-",
        _three(sum(starmap(eq, zip(words, words[1:]))) / n, 0.03, 0.15) if n >= 10 else "-",
        _three(sum(map(STOP_WORDS.__contains__, plain)) / n, 0.12, 0.03) if n >= 20 else "-",
        _three(sum(map(INSULTS.__contains__, plain)), 0, max(2, n / 200)),
    ]
    return "".join(out)


# How a labeler is taken to vote at the start, on good and on bad documents.  Bad documents
# are of many kinds, of which a labeler knows one or two: it calls the others good.
_START = ({"0": 0.96, "1": 0.04}, {"0": 0.45, "1": 0.55})
# Who labels a text toxic has read it; a list of insults knows one language, and would outvote the label.
_READ = ({"0": 0.999, "1": 0.001}, {"0": 0.001, "1": 0.999})


def accuracies(
    patterns: list[tuple[str, float]], rounds: int = 50, trusted: dict[int, tuple[dict, dict]] | None = None
) -> tuple[float, list[tuple[dict, dict]]]:
    """Expectation-maximisation over (votes, count): the share of bad documents, and for every
    labeler P(vote | good) and P(vote | bad); to abstain says nothing.  ``trusted`` ones keep theirs."""
    width = len(patterns[0][0]) if patterns else 0
    trusted = trusted or {}
    share, given = 0.2, [trusted.get(k, _START) for k in range(width)]
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        bad_sum, sums = 1.0, [tuple(dict(side) for side in _START) for _ in range(width)]
        for vote, n in patterns:
            p = posterior(vote, share, given)
            bad_sum += n * p
            for k, v in enumerate(vote):
                if v != "-":
                    sums[k][0][v] += n * (1 - p)
                    sums[k][1][v] += n * p
        share = min(0.9, max(0.001, bad_sum / (total + 2)))
        given = [tuple({v: x / sum(side.values()) for v, x in side.items()} for side in pair) for pair in sums]
        given = [trusted.get(k, pair) for k, pair in enumerate(given)]
    return share, given


def posterior(vote: str, share: float, given: list) -> float:
    odds = math.log(share / (1 - share))
    for v, (good, bad) in zip(vote, given):
        if v != "-":
            odds += math.log(bad[v] / good[v])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


# ---- scorer ------------------------------------------------------------------------------


def _slots(word: str) -> tuple[int, ...]:
    """Places of a word's features: itself, two lengths of how it begins, its shape."""
    low = word.lower()
    if word.isalpha():
        shape = "A" if word.isupper() else "a"
    else:
        shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "0", _UPPER.sub("A", word))))
    keys = (f"w{low}", f"b{low[:4]}", f"c{low[:6]}", f"s{shape}")
    return tuple(zlib.crc32(k.encode()) % DIMENSIONS for k in keys)


def _counted(text: str) -> tuple[Counter, int]:
    """Words with their counts; two further entries say how often words repeat."""
    words = text.split()
    counts = Counter(words)
    kinds = len(counts)
    if same := sum(starmap(eq, zip(words, words[1:]))):
        counts["\x00same"] = same
    counts["\x00again"] = len(words) - kinds
    return counts, len(words)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and values: the root of a word's share of the text, for each feature."""
    counts, n = _counted(text)
    at = np.array([s for w in counts for s in _slots(w)], dtype=np.int32)
    values = np.sqrt(np.repeat(np.fromiter(counts.values(), float, len(counts)), _PER_WORD) / max(1, n))
    places, back = np.unique(at, return_inverse=True)
    return places, np.bincount(back, values, len(places)).astype(np.float32)


class Scorer:
    """A task's weights by word, a bounded number of which are kept; others are summed anew.

    Both heads' weights of a word stand in a row of ``table``; ``rows`` says in which.
    """

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias
        self.rows: dict[str, int] = {}
        self.table = np.zeros((0, 2))

    def _summed(self, words: list[str]) -> np.ndarray:
        at = np.array([_slots(w) for w in words], dtype=np.int64).reshape(-1, _PER_WORD)
        return self.weights[:, at].sum(axis=2, dtype=np.float64).T

    def probabilities(self, texts: list[str | None]) -> list[tuple[float, float]]:
        counted = [_counted(t or "") for t in texts]
        places = [np.fromiter((self.rows.get(w, -1) for w in c), np.int64, len(c)) for c, _ in counted]
        lacking: dict[str, int] = {}
        size = len(self.table)
        for (counts, _), at in zip(counted, places):
            gaps = at < 0
            if gaps.any():
                at[gaps] = [size + lacking.setdefault(w, len(lacking)) for w in compress(counts, gaps)]
        new = list(lacking)
        table = np.concatenate([self.table, self._summed(new)]) if new else self.table
        room = max(0, _WEIGHTS_KEPT - size)
        self.rows.update(zip(new[:room], range(size, size + room)))
        self.table = table[: size + min(room, len(new))]
        out = []
        for (counts, n), at in zip(counted, places):
            if n:
                roots = np.sqrt(np.fromiter(counts.values(), float, len(counts)) / n)
                bad, toxic = roots @ table[at] + self.bias
                out.append((_sigmoid(bad), _sigmoid(toxic)))
            else:
                out.append((1.0, 0.0))
        return out


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _telling(places: list[np.ndarray], wanted: list[float], deviations: float) -> np.ndarray:
    """The places whose documents' targets lie that many standard deviations off what chance gives.

    Rare words, of which a text may have hundreds, would otherwise explain the sample by heart.
    """
    met, sums = np.zeros(DIMENSIONS, np.int64), np.zeros(DIMENSIONS)
    for at, target in zip(places, wanted):
        met[at] += 1
        sums[at] += target
    share = sum(wanted) / len(wanted)
    chance = np.sqrt(met * share * (1 - share))
    return (met >= LEAST_DOCUMENTS) & (np.abs(sums - met * share) >= deviations * chance)


def train(rows: pd.DataFrame, epochs: tuple[int, int] = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Logistic weights of both heads by AdaGrad.

    ``rows``: (places, values, bad, toxic); a target that is NaN leaves its head alone.
    Features of fewer than ``LEAST_DOCUMENTS`` rows are left out, as they only memorise, and
    so are those nearer to chance than ``LEAST_DEVIATIONS``.
    """
    weights, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2)
    for head, target in enumerate(("bad", "toxic")):
        mine = rows[rows[target].notna()]
        if mine.empty:  # nothing was said, so nothing is rejected for it
            bias[head] = -30.0
            continue
        squares, bias_square = np.full(DIMENSIONS, 1e-4, np.float32), 1e-4
        order, rate = np.random.default_rng(0), RATES[head]
        places, values, wanted = (mine[c].to_list() for c in ("places", "values", target))
        telling = _telling(places, wanted, LEAST_DEVIATIONS[head])
        kept = [telling[at] for at in places]
        places = [at[k] for at, k in zip(places, kept)]
        values = [x[k] for x, k in zip(values, kept)]
        for _ in range(epochs[head]):
            for i in order.permutation(len(mine)):
                at, x = places[i], values[i]
                error = _sigmoid(float(weights[head, at] @ x) + bias[head]) - wanted[i]
                error *= 1 + (POSITIVE_WEIGHTS[head] - 1) * wanted[i]
                slope = error * x
                squares[at] += slope * slope
                weights[head, at] -= rate * slope / np.sqrt(squares[at])
                bias_square += error * error
                bias[head] -= rate * error / math.sqrt(bias_square)
    return weights, bias


# ---- operator ----------------------------------------------------------------------------


def _known(labels: DataFrame) -> DataFrame:
    """(doc_id, said): two signs per labelled document, low quality and toxic."""
    means = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.avg("quality").alias("q"), F.avg("toxic").alias("t")
    )
    low = F.when(F.col("q").isNull(), "-").when(F.col("q") > 0.5, "0").otherwise("1")
    toxic = F.when(F.col("t").isNull(), "-").when(F.col("t") >= 0.5, "1").otherwise("0")
    return means.select("doc_id", F.concat(low, toxic).alias("said"))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of the scorer for (doc_id, text) and (doc_id, quality, toxic)."""

    @F.pandas_udf("string")
    def vote(texts: pd.Series) -> pd.Series:
        drop_held()
        return pd.Series([votes(t or "") for t in texts], dtype=object)

    voted = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), vote("text").alias("votes"))
    voted = voted.join(_known(labels), "doc_id", "left").withColumn("said", F.coalesce("said", F.lit("--")))
    voted = staged(voted, "votes")
    patterns = voted.groupBy("votes", "said").count().collect()
    q = len(QUALITY_LABELERS)
    low = accuracies([(r["votes"][:q] + r["said"][0], r["count"]) for r in patterns])
    toxic = accuracies(
        [(r["votes"][q:] + r["said"][1], r["count"]) for r in patterns], trusted={len(TOXIC_LABELERS): _READ}
    )

    labelled = sum(r["count"] for r in patterns if r["said"] != "--")
    rest = sum(r["count"] for r in patterns) - labelled
    first = min(labelled, int(train_rows * LABELLED_SHARE))
    shares = (first / max(1, labelled), min(1.0, (train_rows - first) / max(1, rest)))
    drawn = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(_DRAW)) / _DRAW
    chosen = voted.where(drawn < F.when(F.col("said") != "--", shares[0]).otherwise(shares[1]))
    # Rows that repeat wholly are drawn together and count once, which bounds the sample.
    chosen = chosen.dropDuplicates(["doc_id", "text_hash"])

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drop_held()
        for batch in batches:
            made = [features(t or "") for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "text_hash": batch["text_hash"],
                    "votes": batch["votes"],
                    "said": batch["said"],
                    "places": [p for p, _ in made],
                    "values": [v for _, v in made],
                }
            )

    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    picked = texts.join(F.broadcast(chosen), ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])
    rows = picked.select("text", "text_hash", "votes", "said").mapInPandas(
        featured, "text_hash long, votes string, said string, places array<int>, values array<float>"
    )

    # That a list of one language finds nothing teaches nothing about the others, and what it finds
    # would come without its counterpart: if labels tell both classes, unlabelled rows leave the toxic head alone.
    told = {"0", "1"} <= {r["said"][1] for r in patterns}

    def targets(heads: pd.Series, model: tuple, labelled_only: bool = False) -> list[float]:
        left = heads.str.endswith("-") if labelled_only else ~heads.str.contains("[01]")
        return [math.nan if out else posterior(x, *model) for x, out in zip(heads, left)]

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drop_held()
        parts = list(batches)
        if not parts:
            return
        sample = pd.concat(parts, ignore_index=True).sort_values(["text_hash", "votes", "said"], ignore_index=True)
        sample["bad"] = targets(sample["votes"].str[:q] + sample["said"].str[0], low)
        sample["toxic"] = targets(sample["votes"].str[q:] + sample["said"].str[1], toxic, told)
        weights, bias = train(sample)
        yield pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias.tobytes()]})

    # The sample is bounded, so one task trains on it; only the weights reach the driver.
    row = rows.repartition(1).mapInPandas(fitted, "weights binary, bias binary").first()
    if row is None:
        return np.zeros((2, DIMENSIONS), np.float32), np.full(2, -30.0)
    return np.frombuffer(row["weights"], np.float32).reshape(2, DIMENSIONS), np.frombuffer(row["bias"], np.float64)


def judged(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """All rows and columns of ``docs`` with ``__p`` (low_quality, toxic), both probabilities."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, train_rows))

    @F.pandas_udf("low_quality double, toxic double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        drop_held()
        # One scorer per task: what it keeps is freed before the worker serves another stage.
        scorer = Scorer(*model.value)
        for texts in batches:
            values, out = texts.tolist(), []
            for low in range(0, len(values), _TEXTS):
                out += scorer.probabilities(values[low : low + _TEXTS])
            yield pd.DataFrame(out, columns=["low_quality", "toxic"])

    return docs.withColumn("__p", score("text"))


def is_rejected(threshold: float = REJECTED) -> Column:
    return (F.col("__p.low_quality") >= threshold) | (F.col("__p.toxic") >= threshold)


@shielded("doc_id", "text")
def accepted(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    return judged(docs, labels, train_rows).where(~is_rejected()).drop("__p")
