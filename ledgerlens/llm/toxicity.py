"""Toxicity by weak supervision (operator 2, Arrow tasks and a Spark ML classifier).

Voters look at whole texts: lists of words, patterns, and lists of terms that labelled toxic rows use more often than
clean ones. None is trusted. A generative label model with a hidden class estimates from the votes of all training rows how
often each voter fires in either class, finds the voters that are correlated beyond the class, gives those a joint table,
and returns the probability of the class for each combination of votes. A logistic regression on the terms of a text is
then trained on these posterior labels, and its probability is the score.

Labels are learned only from rows for which crc32(doc_id as text) mod ``folds`` is not 0; the score depends on the text
alone. At most ``sample_rows`` labelled rows of each class choose the terms (those with the smallest hashes of the id), and
at most ``fit_rows`` training rows fit the regression; votes, label model and scores use all rows.

Cases: a null or empty text has no terms and gets the score of the intercept. Rows with null ids or labels train nothing.
Repeated rows get equal scores. Without a labelled row of each class the term lists are empty and the fixed voters remain.
An empty table gives no rows. Further columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from ledgerlens.llm.arrays import text_blocks
from ledgerlens.llm.exact_dedup import free_name
from ledgerlens.llm.minhash_join import shingles
from ledgerlens.session import stage

FOLDS = 5
SAMPLE_ROWS = 10_000
FIT_ROWS = 40_000
VOCABULARY = 4096
MINED_LISTS = 6
LEAST_ROWS = 4
LEAST_RATIO, LEAST_ODDS = 15.0, 4.0
WORD = re.compile(r"[^\W\d_]+")
# Voters that know no label: common insults, threats and obscenities of English, and patterns of writing.
INSULTS = frozenset(
    "idiot moron stupid dumb fool loser pathetic worthless disgusting trash garbage scum clown ugly jerk creep coward liar "
    "imbecile cretin lunatic psycho freak pig rat vermin filth filthy degenerate failure useless hateful ignorant brainless".split()
)
HARSH = frozenset("hate kill die hurt destroy shut damn hell crap bastard bitch shit fuck fucking ass asshole piss slut whore".split())
PATTERNS = [re.compile(r"\b(?:you|u) (?:are|r) (?:a |an |such |so )"), re.compile(r"[!?]{3,}"), re.compile(r"(\w)\1{3,}")]
FIXED_VOTERS = 2 + len(PATTERNS)


def training_rows(folds: int = FOLDS):
    """True for ids whose label may be learned; the other rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != 0


def terms_of(word: str) -> tuple[str, ...]:
    """A word and its first four and five letters, which inflected and compounded forms share."""
    return (word, *(word[:n] + "*" for n in (4, 5) if len(word) > n))


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def term_counts(labelled: DataFrame) -> DataFrame:
    """term, and in how many toxic and clean rows it stands; rows of a task are summed before they are shuffled."""

    def count(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([s[t] for t in terms], pa.int64()) for s in seen)], ["term", "n_clean", "n_toxic"])
            seen[0].clear(), seen[1].clear()

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                seen[label.as_py()].update({t for w in words_of(text.as_py() or "") for t in terms_of(w)})
                if len(seen[0]) + len(seen[1]) > 400_000:
                    yield from flush()
        yield from flush()

    counted = labelled.select("text", "label").mapInArrow(count, "term string, n_clean bigint, n_toxic bigint")
    return counted.groupBy("term").agg(F.sum("n_clean").alias("n_clean"), F.sum("n_toxic").alias("n_toxic"))


@dataclass
class Terms:
    """The terms of the classifier, in order, and for each the list that it votes in (-1: none)."""

    names: list[str]
    lists: list[int]


def mine(labelled: DataFrame, size: int = VOCABULARY, lists: int = MINED_LISTS) -> Terms:
    """The terms whose share differs most between toxic and clean rows by the likelihood ratio (G^2), as far as that is no
    accident. Terms that are almost never clean vote in the lists."""
    total = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not total.get(0) or not total.get(1):
        return Terms([], [])
    toxic, clean, rows = F.col("n_toxic"), F.col("n_clean"), total[0] + total[1]
    part = lambda n, own: F.when(n > 0, n * F.log(n / ((toxic + clean) * own / rows))).otherwise(0.0)
    odds = F.log((toxic + 0.5) / (total[1] + 1 - toxic)) - F.log((clean + 0.5) / (total[0] + 1 - clean))
    counted = term_counts(labelled).filter(toxic + clean >= LEAST_ROWS)
    ratio = counted.withColumn("ratio", 2 * (part(toxic, total[1]) + part(clean, total[0]))).withColumn("odds", odds)
    best = ratio.filter(F.col("ratio") >= LEAST_RATIO).orderBy(F.col("ratio").desc(), "term").limit(size).collect()
    strong = [r["term"] for r in best if r["odds"] >= LEAST_ODDS]
    at = {t: i % lists for i, t in enumerate(strong)}
    return Terms([r["term"] for r in best], [at.get(r["term"], -1) for r in best])


def single(labelled: DataFrame) -> DataFrame:
    """``labelled`` (text, label) with one row for each smallest three-word shingle, so that the words of a text with many
    near copies don't look like a rule."""

    def least(batches):
        for batch in batches:
            for first, last, raw, at in text_blocks(batch.column(0)):
                hashes, ends = shingles(raw, at, 3)
                names = [int(hashes[a:b].min().view("i8")) if b > a else None for a, b in zip(ends[:-1], ends[1:])]
                rows = [batch.column(i).slice(first, last - first) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(names, pa.int64())], ["text", "label", "least"])

    return labelled.select("text", "label").mapInArrow(least, "text string, label int, least bigint").dropDuplicates(["label", "least"]).drop("least")


def votes_and_terms(docs: DataFrame, terms: Terms) -> DataFrame:
    """The columns of ``docs`` but the text, ``votes`` (a bit for each voter that fires), ``found`` (numbers of the terms that
    stand in the text)."""
    names, lists = terms.names, terms.lists
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(*kept).schema.add("votes", IntegerType()).add("found", ArrayType(IntegerType()))

    def look(batches):
        number = {t: i for i, t in enumerate(names)}
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            votes, found = [], []
            for value in batch.column(len(kept)):
                text = (value.as_py() or "").lower()
                words, hits = set(WORD.findall(text)), set()
                for w in words:
                    own = known.get(w)
                    if own is None:
                        own = tuple(number[t] for t in terms_of(w) if t in number)
                        if len(w) < 30:
                            if len(known) > 300_000:
                                known.clear()
                            known[w] = own
                    hits.update(own)
                bits = (not words.isdisjoint(INSULTS)) | (not words.isdisjoint(HARSH)) << 1
                for i, pattern in enumerate(PATTERNS):
                    bits |= (pattern.search(text) is not None) << (2 + i)
                for h in hits:
                    if lists[h] >= 0:
                        bits |= 1 << (FIXED_VOTERS + lists[h])
                votes.append(bits)
                found.append(sorted(hits))
            own = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(votes, pa.int32()), pa.array(found, pa.list_(pa.int32()))], [*kept, "votes", "found"])

    return docs.select(*kept, "text").mapInArrow(look, schema)


class LabelModel:
    """Hidden-class model of votes. Voters in one block share a joint table for each class, blocks are independent given it."""

    def __init__(self, voters: int, widest: int = 3, least_correlation: float = 0.15):
        self.voters, self.widest, self.least = voters, widest, least_correlation
        self.blocks = [[v] for v in range(voters)]

    def _cells(self, votes: np.ndarray) -> list[np.ndarray]:
        bits = (votes[:, None] >> np.arange(self.voters)) & 1
        return [bits[:, b] @ (1 << np.arange(len(b))) for b in self.blocks]

    def _maximise(self, votes, mass):
        """Class share and block tables for the mass of (pattern, class), with one added vote spread over each table."""
        self.prior = (mass.sum(axis=0) + 1) / (mass.sum() + 2)
        self.tables = []
        for cells, block in zip(self._cells(votes), self.blocks):
            size = 2 ** len(block)
            table = np.stack([np.bincount(cells, mass[:, y], size) + 1 / size for y in (0, 1)], axis=1)
            self.tables.append(table / table.sum(axis=0))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each pattern of votes."""
        log = np.log(self.prior)[None, :] + sum(np.log(t[c]) for c, t in zip(self._cells(votes), self.tables))
        log -= log.max(axis=1, keepdims=True)
        p = np.exp(log)
        return p[:, 1] / p.sum(axis=1)

    def _climb(self, votes, counts, known, rounds=200):
        """Expectation and maximisation until the class shares rest; labelled mass keeps its class."""
        old = None
        for _ in range(rounds):
            p = np.where(known >= 0, known, self.posterior(votes))
            mass = np.stack([counts * (1 - p), counts * p], axis=1)
            self._maximise(votes, mass)
            if old is not None and np.abs(p - old).max() < 1e-7:
                break
            old = p
        return mass

    def correlations(self, votes, mass) -> np.ndarray:
        """Largest absolute correlation of two voters within a class."""
        bits, most = ((votes[:, None] >> np.arange(self.voters)) & 1).astype(float), np.zeros((self.voters, self.voters))
        for y in (0, 1):
            w = mass[:, y] / mass[:, y].sum()
            centred = bits - w @ bits
            cov = (centred * w[:, None]).T @ centred
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            most = np.maximum(most, np.abs(cov / np.outer(sd, sd)))
        np.fill_diagonal(most, 0)
        return most

    def fit(self, votes: np.ndarray, counts: np.ndarray, known: np.ndarray) -> LabelModel:
        """``known`` is the label of a pattern's rows, -1 where they have none."""
        fired = ((votes[:, None] >> np.arange(self.voters)) & 1).sum(axis=1)
        start = np.where(known >= 0, known, np.clip(0.02 + 0.3 * fired, 0, 0.95))
        self._maximise(votes, np.stack([counts * (1 - start), counts * start], axis=1))
        mass = self._climb(votes, counts, known)
        found = self.correlations(votes, mass)
        for a, b in sorted(zip(*np.nonzero(np.triu(found > self.least))), key=lambda p: -found[p]):
            one, two = (next(x for x in self.blocks if v in x) for v in (a, b))
            if one is not two and len(one) + len(two) <= self.widest:
                self.blocks = [x for x in self.blocks if x is not one and x is not two] + [sorted(one + two)]
        self._maximise(votes, mass)
        self._climb(votes, counts, known)
        return self


def label_model(marked: DataFrame, voters: int) -> LabelModel:
    """Fitted on the counts of each pattern of votes by label: at most 3 x 2^voters rows, whatever the table holds."""
    rows = marked.groupBy("votes", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    table = np.array([(r["votes"], r["n"], -1 if r["label"] is None else r["label"]) for r in rows], np.int64).reshape(-1, 3)
    return LabelModel(voters).fit(table[:, 0], table[:, 1].astype(float), table[:, 2])


def term_vector(size: int):
    return F.udf(lambda found: SparseVector(size, found, [1.0] * len(found)), VectorUDT())


def classifier(rows: DataFrame, size: int):
    """Logistic regression on term vectors and posterior labels: each row counts for both classes by its posterior."""
    both = rows.select(
        term_vector(size)("found").alias("features"),
        F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")))).alias("y"),
    ).select("features", "y.*").filter("weight > 0")
    fit = LogisticRegression(labelCol="label", weightCol="weight", regParam=2e-4, maxIter=60, standardization=False)
    return fit.fit(stage(both, "posterior"))


def score(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, sample_rows: int = SAMPLE_ROWS, fit_rows: int = FIT_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, held_out, score, predicted, posterior (what the voters alone say) for every row of ``docs``."""
    docs = docs.select("doc_id", *keep, "text")
    known = labels.filter(F.col("toxic").isin(0, 1) & training_rows(folds)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # At most twice sample_rows ids: the parameter bounds what is broadcast.
    sample = known.filter("label = 0").orderBy(*order).limit(sample_rows).union(known.filter("label = 1").orderBy(*order).limit(sample_rows))
    sample = stage(sample, "sample")
    labelled = stage(single(docs.join(F.broadcast(sample), "doc_id").select("text", "label")), "labelled")
    terms = mine(labelled)
    marked = stage(votes_and_terms(docs, terms), "votes")
    learn = marked.filter(training_rows(folds)).join(known, "doc_id", "left").select("doc_id", "votes", "found", "label")
    voters = FIXED_VOTERS + MINED_LISTS
    size = max(1, len(terms.names))
    if learn.isEmpty():  # nothing to learn from: every row gets the share that the fixed voters start with
        return scored(marked, np.full(2**voters, 0.5), np.zeros(size), -1.0, folds)
    model = label_model(learn, voters)
    posterior = model.posterior(np.arange(2**voters))
    by_votes = learn.sparkSession.createDataFrame(list(enumerate(posterior.tolist())), "votes int, vote_p double")
    chosen = learn.orderBy(*order, "votes", "found").limit(fit_rows).join(F.broadcast(by_votes), "votes")
    fitted = classifier(chosen.withColumn("p", F.coalesce(F.col("label").cast("double"), "vote_p")), size)
    return scored(marked, posterior, fitted.coefficients.toArray(), float(fitted.intercept), folds)


def scored(marked: DataFrame, posterior: np.ndarray, weights: np.ndarray, intercept: float, folds: int) -> DataFrame:
    """Scores of all rows from the weights of their terms; 2^voters and one number for each term go to the tasks."""
    own = [c for c in marked.columns if c not in ("votes", "found")]

    def weigh(batches):
        for batch in batches:
            found = batch.column(len(own) + 1).cast(pa.list_(pa.int32()))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
            sums = np.concatenate([[0.0], np.cumsum(weights[found.flatten().to_numpy(zero_copy_only=False).astype(np.int64)])])
            margin = np.clip(intercept + sums[ends[1:]] - sums[ends[:-1]], -40, 40)
            p = posterior[batch.column(len(own)).to_numpy()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(own))), pa.array(1 / (1 + np.exp(-margin))), pa.array(p)], [*own, "score", "posterior"])

    schema = marked.select(*own).schema.add("score", DoubleType()).add("posterior", DoubleType())
    out = marked.select(*own, "votes", "found").mapInArrow(weigh, schema)
    held = F.coalesce(~training_rows(folds), F.lit(False))
    return out.select(*own, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "posterior")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Whole rows of ``docs`` that are not predicted to be toxic; rows are told apart by doc_id and text."""
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    rejected = score(docs.select("doc_id", "text", digest.alias("_sha")), labels, keep=("_sha",)).filter("predicted = 1")
    rejected = rejected.select(F.col("doc_id").alias("_id"), "_sha").distinct()
    name = free_name(docs, "_text_sha256")
    marked = docs.withColumn(name, digest)
    same = marked["doc_id"].eqNullSafe(rejected["_id"]) & (marked[name] == rejected["_sha"])
    return marked.join(rejected, same, "left_anti").drop(name)
