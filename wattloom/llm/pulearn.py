"""Quality classifier learned from trusted positives and unlabelled text (non-negative PU risk)."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import batch, chunks, free, remainder, staged

FEATURES = [
    "log_words", "log_lines", "word_length", "long_words", "short_words", "distinct_words", "top_word", "repeat_neighbours", "dup_lines",
    "symbols", "marks", "bars", "digits", "upper", "upper_words", "beyond_ascii", "sentence_ends", "symbol_words", "single_letters", "log_line_words",
]


def features(text: str | None) -> list[float]:
    """Shares and logarithms that describe the whole text; all zero if it has no word."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(raw)
    lengths = np.fromiter(map(len, words), np.int64, n)
    points = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(points, minlength=256)
    upper, lower = int(kinds[65:91].sum()), int(kinds[97:123].sum())
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    neighbours = sum(map(bytes.__eq__, words, words[1:])) if n > 1 else 0
    tails = np.fromiter((w[-1] for w in words), np.uint8, n)
    total = lambda chars: float(kinds[list(chars)].sum())
    return [
        np.log1p(n), np.log1p(len(lines)), lengths.mean(), float((lengths > 15).mean()), float((lengths <= 3).mean()), len(counts) / n, max(counts.values()) / n,
        neighbours / n, 1 - len(set(lines)) / len(lines), total(b"#*$%&<>@^~=+\\{}[]_") / size, total(b"!?") / size, total(b"|") / n, float(kinds[48:58].sum()) / size,
        upper / max(1, upper + lower), sum(map(bytes.isupper, words)) / n, float(kinds[128:].sum()) / size, float(np.isin(tails, list(b".!?")).mean()),
        float(np.isin(tails, list(b"#*$%&|")).mean()), float((lengths == 1).mean()), np.log1p(n / len(lines)),
    ]


class Net:
    """One hidden layer; the output is the log odds of label 1."""

    def __init__(self, width: int, hidden: int, rng: np.random.Generator):
        self.weights = [rng.normal(0, 1 / np.sqrt(width), (width, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        self.moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        self.steps = 0

    def odds(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(x @ a + b) @ c + d[0]

    def gradient(self, x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        a, b, c, _ = self.weights
        h = np.tanh(x @ a + b)
        back = slope[:, None] * c * (1 - h * h)
        return [x.T @ back, back.sum(0), h.T @ slope, np.array([slope.sum()])]

    def flat(self) -> np.ndarray:
        """Weights, moments and steps as one array."""
        return np.concatenate([*map(np.ravel, self.weights), *(x.ravel() for pair in self.moments for x in pair), [float(self.steps)]])

    @classmethod
    def of(cls, flat: list[float], width: int, hidden: int) -> Net:
        net = cls(width, hidden, np.random.default_rng(0))
        places = [*net.weights, *(x for pair in net.moments for x in pair)]
        for place, part in zip(places, np.split(np.array(flat[:-1]), np.cumsum([x.size for x in places])[:-1]), strict=True):
            place[...] = part.reshape(place.shape)
        net.steps = round(flat[-1])
        return net

    def move(self, grads: list[np.ndarray], rate: float, decay: float) -> None:
        self.steps += 1
        for w, g, (m, v) in zip(self.weights, grads, self.moments, strict=True):
            g = g + decay * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)


def fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, epochs: int = 30, size: int = 1024, rate: float = 0.01, decay: float = 1e-4,
    seed: int | list[int] = 0, net: Net | None = None,
) -> Net:
    """Minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss; a given net is trained on.

    Where the second part of a batch falls below zero, its gradient is turned round, so the net gives up
    what it has overfitted instead of driving the estimate further below zero.
    """
    rng = np.random.default_rng(seed)
    net = net or Net(positive.shape[1], hidden, rng)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    steps = max(1, len(unlabelled) // size)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(unlabelled)), steps):
            p, u = positive[rng.integers(0, len(positive), min(size, len(positive)))], unlabelled[part]
            zp, zu = net.odds(p), net.odds(u)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            up, down = net.gradient(u, sigmoid(zu) / len(u)), net.gradient(p, -prior * sigmoid(zp) / len(p))
            rest = [a + b for a, b in zip(up, down, strict=True)]
            if negative < 0:
                net.move([-g for g in rest], rate, 0.0)
            else:
                first = net.gradient(p, -prior * sigmoid(-zp) / len(p))
                net.move([a + b for a, b in zip(first, rest, strict=True)], rate, decay)
    return net


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and features, in single precision, of every row."""

    def run(batches):
        for b in chunks(batches):
            yield batch(pa.schema([("doc_id", pa.int64()), ("features", pa.list_(pa.float32()))]), b.column("doc_id"), [np.asarray(features(t), np.float32) for t in b.column("text").to_pylist()])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, features array<float>")


def dealt(rows: DataFrame, groups: int) -> DataFrame:
    """All rows in `groups` groups by their hash: at, n, mean, spread and the features as bytes, in the order of the ids."""
    schema = pa.schema([("at", pa.int64()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("spread", pa.list_(pa.float64())), ("data", pa.binary())])

    def run(t: pa.Table) -> pa.Table:
        x = t.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1).astype(np.float64)
        x = x[np.lexsort((*x.T[::-1], t.column("doc_id").to_numpy()))]
        return pa.Table.from_batches([batch(schema, [t.column("at")[0].as_py()], [len(x)], [x.mean(0)], [x.std(0)], [x.astype(np.float32).tobytes()])], schema)

    at = F.pmod(F.xxhash64("doc_id", "features"), F.lit(groups)).alias("at")
    return staged(rows.select(at, "doc_id", "features").groupBy("at").applyInArrow(run, "at bigint, n bigint, mean array<double>, spread array<double>, data binary"))


def overall(groups: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of the features over the rows of all groups."""
    got = groups.select("at", "n", "mean", "spread").orderBy("at").collect()
    n, means, spreads = np.array([g.n for g in got], float)[:, None], np.array([g["mean"] for g in got]), np.array([g.spread for g in got])
    if len(got) == 1:
        return means[0], spreads[0]
    mean = (n * means).sum(0) / n.sum()
    return mean, np.sqrt((n * (spreads**2 + (means - mean) ** 2)).sum(0) / n.sum())


def blocks_of(positive: DataFrame, unlabelled: DataFrame) -> tuple[DataFrame, int]:
    """block, p and u: each group of either kind is in one block at least, and their number."""
    ats = [sorted(x.at for x in side.select("at").collect()) for side in (positive, unlabelled)]
    n = max(map(len, ats))
    pairs = positive.sparkSession.createDataFrame([(i, *(side[i % len(side)] for side in ats)) for i in range(n)], "block bigint, p_at bigint, u_at bigint")
    side = lambda df, c: df.select(F.col("at").alias(f"{c}_at"), F.col("data").alias(c))
    return staged(F.broadcast(pairs).join(side(positive, "p"), "p_at").repartition(n, "block").join(side(unlabelled, "u"), "u_at").repartition(n, "block").select("block", "p", "u")), n


def trained(blocks: DataFrame, n: int, mean: np.ndarray, spread: np.ndarray, prior: float, seed: int, epochs: int = 30, rounds: int = 10) -> Net:
    """A net that every row of the blocks has taught: in each round every block trains the net on, then the nets are averaged.

    A single block needs no rounds.
    """
    width = len(mean)
    net = None if n == 1 else Net(width, 16, np.random.default_rng(seed))
    for r in range(1 if n == 1 else rounds):

        def run(batches, net=net, r=r):
            for b in batches:
                for block, *sides in zip(*[b.column(c).to_pylist() for c in ("block", "p", "u")], strict=True):
                    p, u = ((np.frombuffer(x, np.float32).reshape(-1, width).astype(np.float64) - mean) / spread for x in sides)
                    got = fit(p, u, prior, seed=seed) if net is None else fit(p, u, prior, epochs=epochs // rounds, seed=[seed, r, block], net=pickle.loads(pickle.dumps(net)))
                    yield pa.RecordBatch.from_pydict({"state": [got.flat()]})

        states = blocks.mapInArrow(run, "state array<double>")
        if n > 1:
            # A sum of decimals does not depend on the order of the blocks.
            value = F.posexplode("state").alias("at", "x")
            states = states.select(value).groupBy("at").agg((F.sum(F.col("x").cast("decimal(38,20)")).cast("double") / n).alias("x")).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda s: s.x).alias("state"))
        net = Net.of(states.first().state, width, 16)
    return net


def classifier(measures: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, block_rows: int = 40_000, prior: float | None = None, seed: int = 0):
    """A function from features to the log odds of label 1, learned from all rows of `measures` (see measured()) that are not held out.

    Trusted positives are rows with label 1; unlabelled rows are rows without a label (labelled rows too if all are
    labelled). Counts, mean, spread and net come from all of them, in blocks of about `block_rows` rows of either kind. The class prior is
    a parameter, or the share of label 1 among the labelled learning rows. An id with different labels counts as 0. With
    no positive at all the odds are those of the prior. Rows with a null id are not learned from.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"))
    table = staged(learning(measures, modulus, held).join(marked, "doc_id", "left"))
    shares = table.where("quality IS NOT NULL").select("doc_id", "quality").distinct().agg(F.avg(F.col("quality").cast("double")).alias("share"), F.count("*").alias("n")).first()
    prior = shares.share if prior is None and shares.n else prior
    prior = min(max(0.5 if prior is None else prior, 0.02), 0.98)
    positive, unlabelled = table.where("quality = 1"), table.where("quality IS NULL")
    n_positive, n_unlabelled = positive.count(), unlabelled.count()
    if not n_positive:
        return lambda x: np.full(len(x), np.log(prior / (1 - prior)))
    if not n_unlabelled:
        unlabelled, n_unlabelled = table, table.count()
    positive, unlabelled = (dealt(side.select("doc_id", "features"), -(-k // block_rows)) for side, k in ((positive, n_positive), (unlabelled, n_unlabelled)))
    mean, spread = overall(unlabelled)
    spread = spread + 1e-3
    net = trained(*blocks_of(positive, unlabelled), mean, spread, prior, seed)
    return lambda x: net.odds(np.clip((x - mean) / spread, -8, 8))


def learning(docs: DataFrame, modulus: int, held: int) -> DataFrame:
    """Rows with an id that are not held out."""
    rest = remainder("doc_id", modulus)
    return docs.where((rest != held) & (rest >= 0))


def probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def scored(docs: DataFrame, odds, name: str = "_score") -> DataFrame:
    """All columns of `docs` and a last column, the probability of label 1."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        for b in chunks(batches):
            x = np.array([features(t) for t in b.column("text").to_pylist()], np.float64)
            # Features as the learner saw them, in single precision.
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(probability(odds(x.astype(np.float32).astype(np.float64))))], names=[*b.schema.names, name])

    return docs.mapInArrow(run, f"{kinds}, {name} double")


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every document row, from the text alone.

    See classifier() for what is learned. An empty or null text scores like the features of a text without
    words. Null ids get a score; repeated rows are scored alike. Other columns are not read.
    """
    # Every text is measured once, to learn from and to be scored.
    measures = staged(measured(docs))
    odds = classifier(measures, labels, modulus, held, **options)

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(probability(odds(x)))], names=["doc_id", "_score"])

    got = measures.mapInArrow(run, "doc_id bigint, _score double")
    return got.select("doc_id", (remainder("doc_id", modulus) == held).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, modulus: int = 4, held: int = 2, **options) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold; a row that scores below it goes."""
    name = free("_score", docs.columns)
    measures = staged(measured(learning(docs, modulus, held)))
    return scored(docs, classifier(measures, labels, modulus, held, **options), name).where(F.col(name) >= threshold).select(*[f"`{c}`" for c in docs.columns])
