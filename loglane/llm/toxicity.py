"""Toxicity scores by weak supervision.

1. Voters. From labelled rows Spark counts, per word, per word beginning (4 to
   8 letters) and per beginning that several words share, the toxic and other texts that have it. Those that are
   frequent in toxic texts and rare elsewhere become voters, one for each word
   (lexicon) or beginning (pattern); a short public word list and two phrase
   patterns vote too. A voter says "toxic" or abstains.
2. Label model. The true label is latent; each voter has a rate of firing on
   toxic and on other texts, estimated by expectation maximisation over the
   votes of a sample, labelled or not. Correlations between voters given the
   label are estimated from residuals, and a voter's evidence is divided by
   one plus the variance it shares with others (squares of its positive
   correlations), so that ten spellings of one word do not count ten times.
3. Classifier. A logistic regression on the terms learns the posterior labels
   of the sample; its margin is calibrated on the labelled rows.

Rows with crc32(doc_id as text) mod 3 = 1 are held out of all of this. Voters
and models are fitted on at most about ``MAX_LABELLED`` labelled and
``MAX_UNLABELLED`` other rows, chosen by a hash of the id; every row is scored,
over its whole text, and only from its text.

Defined results: null and empty texts get the score of a text without terms;
without labelled rows of both kinds every score is 0; a null doc_id is not
held out and never trains; repeated rows score alike; of several labels for
one doc_id the largest counts; extra columns are kept by ``score_documents``.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .common import pieces, read_table, ship_package, stored

#: Bounds of the model: sampled rows, terms with a weight, and of these the most
#: frequent that take part in the label model (it is quadratic in them).
MAX_LABELLED = 20_000
MAX_UNLABELLED = 10_000
MAX_TERMS = 512
MAX_VOTERS = 96
MIN_PRECISION = 0.9
THRESHOLD = 0.7
HELD_OUT = 1
#: A short list of common English insults.
PUBLIC_WORDS = ["clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
#: Phrase patterns.
PATTERNS = [r"\byou(?:'re| are)? (?:an? |such an? )?(?:idiot|moron|loser|clown)\b", r"\b(?:shut up|go to hell|drop dead)\b"]
#: Lengths of word beginnings that may become pattern voters.
BEGINNINGS = (4, 5, 6, 7, 8)
WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = [re.compile(p) for p in PATTERNS]


def terms_of(text: str | None) -> set[str]:
    """Of a lower-cased text: its words, the beginnings of its words marked by a
    star, and those that two different words or more share marked by two."""
    words = set(WORD.findall((text or "").lower()))
    begins = Counter(w[:n] for n in BEGINNINGS for w in words if len(w) > n)
    return words | {b + "*" for b in begins} | {b + "**" for b, k in begins.items() if k > 1}


@dataclass
class Model:
    """``terms``: weight of each term; the margin is their sum and ``bias``."""

    terms: dict[str, float]
    bias: float
    scale: float
    shift: float
    voters: list[str]
    accuracies: list[float]

    def scorer(self):
        words = {t: w for t, w in self.terms.items() if t[-1] != "*"}
        begins: dict[int, set[str]] = {}
        for t in self.terms:
            if t[-1] == "*":
                begins.setdefault(len(t.rstrip("*")), set()).add(t.rstrip("*"))

        def score(text: str | None) -> float:
            found = set(WORD.findall((text or "").lower()))
            z = sum([words[w] for w in words.keys() & found])
            for n, known in begins.items():
                hits = [b for w in found if len(w) > n and (b := w[:n]) in known]
                if hits:
                    z += sum([self.terms.get(b + "*", 0.0) + (self.terms.get(b + "**", 0.0) if k > 1 else 0.0)
                              for b, k in Counter(hits).items()])
            return float(1 / (1 + np.exp(-np.clip(self.scale * (z + self.bias) + self.shift, -30, 30))))

        return score


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


def _share(bound: int, rows: int, tag: str):
    return F.pmod(F.xxhash64("doc_id", F.lit(tag)), F.lit(1_000_000)) < int(1e6 * min(1.0, bound / max(rows, 1)))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the bounded sample; toxic is null for unlabelled rows."""
    d = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out())
    y = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    y = y.where(~held_out())
    n_labels, n_docs = y.count(), d.count()
    y = y.where(_share(MAX_LABELLED, n_labels, "labelled"))
    wide = d.join(F.broadcast(y), "doc_id", "left")  # about MAX_LABELLED narrow rows
    pick = F.col("toxic").isNotNull() | _share(MAX_UNLABELLED, n_docs, "other")
    # a row per id, also where an id repeats: so the sample is bounded
    return wide.where(pick).groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic, other): labelled texts of each kind that have the term."""

    def count(batches):
        seen: dict[str, list[int]] = {}
        for b in pieces(batches, "text"):
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for term in terms_of(t):
                    seen.setdefault(term, [0, 0])[0 if y else 1] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in (0, 1))],
            ["term", "toxic", "other"])

    return (rows.where("toxic is not null").mapInArrow(count, "term string, toxic long, other long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))


def choose_terms(counts: DataFrame, n_toxic: int) -> list[str]:
    least = max(3, n_toxic // 500)
    good = (F.col("toxic") + 0.5) / (F.col("toxic") + F.col("other") + 1.0) >= MIN_PRECISION
    rows = counts.where((F.col("toxic") >= least) & good).orderBy(F.desc("toxic"), "term").limit(MAX_TERMS).collect()
    return [r["term"] for r in rows]


def votes(rows: DataFrame, terms: list[str]) -> tuple[list[list[int]], list[int | None]]:
    """Of each sampled row the places of its terms (then of list and pattern
    voters) and its label. The sample is bounded, and so is what is collected."""
    place = {t: i for i, t in enumerate(terms)}
    listed, n = set(PUBLIC_WORDS), len(terms)

    def run(batches):
        for b in pieces(batches, "text"):
            hits = []
            for t in b.column(0).to_pylist():
                found = terms_of(t)
                own = [place[x] for x in found & place.keys()]
                own += [n] if found & listed else []
                own += [n + 1 + i for i, p in enumerate(_PATTERNS) if p.search((t or "").lower())]
                hits.append(sorted(own))
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.list_(pa.int32())), b.column(1)], ["hits", "toxic"])

    out = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "hits array<int>, toxic int").collect()
    return [list(r["hits"]) for r in out], [r["toxic"] for r in out]


def label_model(v: np.ndarray, known: np.ndarray, iterations: int = 25):
    """Posterior of the latent label for each row of votes (0 or 1).

    ``known``: 1, 0 or -1 (not known); known labels give the base rate, start
    the estimate and keep half their weight. Returns posterior, rates (toxic, other), weights."""
    n, silent = len(v), ~v.any(axis=1)
    p = np.where(known >= 0, np.clip(known, 0.02, 0.98), 0.0)
    p[known < 0] = np.where(v[known < 0].any(axis=1), 0.8, 0.05)
    prior = float(np.clip(known[known >= 0].mean() if (known >= 0).any() else 0.1, 1e-3, 1 - 1e-3))
    for _ in range(iterations):
        a = (p @ v + 0.5) / (p.sum() + 1.0)
        b = ((1 - p) @ v + 0.05) / ((1 - p).sum() + 1.0)
        residual = v - (np.outer(p, a) + np.outer(1 - p, b))
        cov = residual.T @ residual / n
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        corr = np.clip(cov / np.outer(sd, sd), 0, 1)
        np.fill_diagonal(corr, 0)
        weight = 1 / (1 + (corr ** 2).sum(axis=1))
        # one abstention is no evidence; that all abstain speaks for the other label
        silence = np.log(((p[silent].sum() + 0.5) / (p.sum() + 1)) / (((1 - p)[silent].sum() + 0.5) / ((1 - p).sum() + 1)))
        z = np.log(prior / (1 - prior)) + v @ (np.log(a / b) * weight) + silent * min(silence, 0.0)
        model = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p = np.where(known >= 0, 0.5 * model + 0.5 * np.clip(known, 0.02, 0.98), model)
    return p, (a, b), weight


def logistic(x: np.ndarray, p: np.ndarray, penalty: float = 1e-3, iterations: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels (gradient
    descent with momentum)."""
    w, c = np.zeros(x.shape[1], np.float32), float(np.log((p.mean() + 1e-4) / (1 - p.mean() + 1e-4)))
    vw, vc = np.zeros_like(w), 0.0
    x = x.astype(np.float32, copy=False)
    balance = np.where(p > 0.5, 0.5 / max((p > 0.5).mean(), 1e-3), 0.5 / max((p <= 0.5).mean(), 1e-3)).astype(np.float32)
    rate = 4.0 / max(1.0, float((x.sum(axis=1) + 1).mean()))
    for _ in range(iterations):
        q = 1 / (1 + np.exp(-np.clip(x @ w + c, -30, 30)))
        g = balance * (q - p) / len(p)
        vw = 0.9 * vw - rate * (x.T @ g + penalty * w)
        vc = 0.9 * vc - rate * float(g.sum())
        w, c = w + vw, c + vc
    return w, c


def calibrate(z: np.ndarray, y: np.ndarray, iterations: int = 50) -> tuple[float, float]:
    """Scale and shift that map margins to probabilities on labelled rows (Newton steps)."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    x = np.stack([z, np.ones_like(z)], axis=1)
    t = np.array([1.0, 0.0])
    for _ in range(iterations):
        q = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 1e-6 * np.eye(2)
        t = t - np.clip(np.linalg.solve(h, x.T @ (q - target)), -2, 2)
    return (float(t[0]), float(t[1])) if t[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    ship_package(docs.sparkSession)
    rows = stored(training_rows(docs, labels), "toxic-sample")
    kinds = {r["toxic"]: r["count"] for r in rows.where("toxic is not null").groupBy("toxic").count().collect()}
    n_toxic = sum(n for k, n in kinds.items() if k)
    none = Model({}, -30.0, 1.0, 0.0, [], [])
    if not n_toxic or not kinds.get(0):
        return none
    terms = choose_terms(term_counts(rows), n_toxic)
    if not terms:
        return none
    hits, label = votes(rows, terms)
    width = len(terms) + 1 + len(PATTERNS)
    x = np.zeros((len(hits), width), np.float32)
    for i, h in enumerate(hits):
        x[i, h] = 1
    known = np.array([-1 if y is None else int(y > 0) for y in label])
    voters = [*range(min(MAX_VOTERS, len(terms))), *range(len(terms), width)]
    p, (a, b), _ = label_model(x[:, voters].astype(np.float64), known)
    w, c = logistic(x[:, :len(terms)], p)
    z = x[:, :len(terms)] @ w + c
    scale, shift = calibrate(z[known >= 0].astype(float), known[known >= 0].astype(float))
    names = [*terms, "public list", *PATTERNS]
    return Model({t: float(v) for t, v in zip(terms, w)}, float(c), scale, shift,
                 [names[i] for i in voters], (a / (a + b)).tolist())


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and predicted (columns of these names are replaced)."""
    ship_package(docs.sparkSession)
    src = docs.drop(*(c for c in docs.columns if c.lower() in ("score", "predicted")))
    schema = StructType([*src.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    at = src.columns.index("text")

    def run(batches):
        score = model.scorer()
        for b in pieces(batches, "text"):
            s = [score(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s, pa.float64()), pa.array([int(v >= THRESHOLD) for v in s], pa.int32())],
                [f.name for f in schema.fields])

    return src.mapInArrow(run, schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
