"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier on its posteriors.

Voters are column expressions over the lower-cased whole text, in the JVM: its words meet whole-word lexicons as hashed
sets, one regular expression finds phrases and runs of signs; each votes 1 (toxic), 0 (clean) or abstains. The label model sees only the pattern of votes of a document: the training rows are counted by
(pattern, gold label) in Spark, at most 3^voters x 3 rows whatever the corpus, and the driver fits on those counts by EM
a class prior and, per group of voters, the distribution of their joint vote given the class (a voter's accuracy is
what that distribution gives to the right vote). Groups start as single voters; pairs whose votes stay correlated
within a class beyond CORRELATED are joined (up to MAX_GROUP voters), so that voters that repeat one another are not
counted as independent evidence. A gold label, where the training rows have one, fixes that row's posterior.

The posterior of a training document, by a join on its pattern, is its soft target for a logistic regression over the
hashed cells of the words of the whole text (cells found in the JVM, each 1 / sqrt(cells of the text)) and the votes,
fitted by AdaGrad in one task on at most FIT_ROWS training documents (the labelled ones first, then by hash of the id;
a documented bound, the label model itself counts all of them). Every document is scored by that regression, in Arrow
batches with the weights broadcast (WORD_CELLS + voters + 1 numbers). A null text is an empty one: no words,
every voter abstains, and it gets the score of the intercept; equal texts get equal scores; columns of ``docs`` other
than doc_id and text are carried along untouched. Without training rows the score is 0.5.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from voxgauge.llm.shared import broadcast_if_small, fresh_name

# The words and patterns that the voters look for (our own lists, whole lower-case words).
INSULTS = {
    "en": "idiot idiots moron morons stupid stupidity clown clowns worthless loser losers dumb pathetic imbecile jerk scum trash garbage fool fools",
    "es": "idiota idiotas estúpido estúpida imbécil basura inútil payaso payasos tonto tonta cretino asqueroso asquerosa",
    "de": "idiot idioten dummkopf trottel wertlos versager clown dumm dumme müll blöd blöde depp",
    "fr": "idiot idiote imbécile crétin minable clown débile ordure stupide abruti nul",
}
THREAT_WORDS = "kill killed murder murdered"
POLITE = "thank thanks please gracias merci danke bitte"
#: Phrases and signs, found by one scan of their union; each match is then told apart by its own pattern.
PATTERNS = [
    ("threat", r"shut up|hate you|hurt you|destroy you", 1),
    ("masked", r"[#$%&*@]{3,}", 1),
    ("addressed", r"you(?: are|'re| r)? (?:a |an |such an? )?(?:idiot|moron|loser|clown|fool|joke)", 1),
    ("exclaimed", r"!{3,}", 1),
]

#: Voters whose votes correlate within a class beyond this are modelled as one group, of at most MAX_GROUP voters.
CORRELATED, MAX_GROUP = 0.5, 3
EM_ROUNDS, SMOOTH = 200, 1.0
WORD_CELLS = 1 << 18
EPOCHS, BATCH, RATE, REGULARISE = 12, 256, 0.2, 1e-5
#: Training rows the regression is fitted on, at most (the labelled first); the label model counts all of them.
FIT_ROWS = 20_000


def _words(lower: Column) -> Column:
    return F.regexp_extract_all(lower, F.lit(r"[\p{L}\p{N}]+"), 0)


def _set(words: str) -> Column:
    return F.array(*[F.lit(w) for w in sorted(set(words.split()))])


def voters(text: Column, words: Column | None = None) -> list[tuple[str, Column]]:
    """(name, vote) for every voter: 1 toxic, 0 clean, null to abstain. ``text``: the lower-cased text, never null.

    The text is scanned once for its words, which meet the lexicons as hashed sets, and once for the union of the
    phrase and sign patterns.
    """
    words = _words(text) if words is None else words
    found = F.array_intersect(words, _set(" ".join(INSULTS.values())))  # distinct insults of the text
    out = [(f"insult_{lang}", F.when(F.arrays_overlap(found, _set(listed)), 1)) for lang, listed in INSULTS.items()]
    marks = F.regexp_extract_all(text, F.lit("|".join(f"(?:{p})" for _, p, _ in PATTERNS)), 0)

    def matching(pattern: str):
        return lambda m: m.rlike(f"^(?:{pattern})$")

    out += [(name, F.when(F.exists(marks, matching(pattern)), vote)) for name, pattern, vote in PATTERNS]
    out += [
        ("threat_word", F.when(F.arrays_overlap(words, _set(THREAT_WORDS)), 1)),
        ("several", F.when(F.size(found) >= 2, 1)),
        ("long_clean", F.when((F.size(words) >= 30) & (F.size(found) == 0), 0)),
        ("polite", F.when(F.arrays_overlap(words, _set(POLITE)), 0)),
    ]
    return out


def shouting(raw: Column) -> Column:
    """1 where at least 20 letters are mostly upper case, else abstain; reads the text as it is."""
    letters, upper = F.regexp_count(raw, F.lit(r"\p{L}")), F.regexp_count(raw, F.lit(r"\p{Lu}"))
    return F.when((letters >= 20) & (upper > 0.6 * letters), 1)


@dataclass
class LabelModel:
    """Prior of class 1, groups of voters and per group P(joint vote | class), rows: outcomes, columns: class 0, 1."""

    prior: float
    groups: list[list[int]]
    tables: list[np.ndarray]
    names: list[str] = field(default_factory=list)

    def accuracy(self, voter: int) -> float:
        """P(the voter's vote is the class | it votes), summed over its group's other members."""
        g = next(i for i, members in enumerate(self.groups) if voter in members)
        at = self.groups[g].index(voter)
        right = total = 0.0
        for outcome in range(3 ** len(self.groups[g])):
            vote = outcome // 3**at % 3  # 0: abstain, 1: votes 0, 2: votes 1
            if vote:
                for y, weight in ((0, 1 - self.prior), (1, self.prior)):
                    p = self.tables[g][outcome, y] * weight
                    total += p
                    right += p if vote - 1 == y else 0
        return right / total if total else 0.5

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(class 1) for rows of votes (0 abstain, 1 votes 0, 2 votes 1)."""
        log = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for members, table in zip(self.groups, self.tables):
            outcome = sum(votes[:, m] * 3**i for i, m in enumerate(members))
            log += np.log(table[outcome])
        log -= log.max(axis=1, keepdims=True)
        p = np.exp(log)
        return p[:, 1] / p.sum(axis=1)


def _fit_groups(votes: np.ndarray, gold: np.ndarray, counts: np.ndarray, groups: list[list[int]]) -> LabelModel:
    """EM over distinct patterns; ``gold``: -1 unknown, else the class that fixes the row's posterior."""
    known = gold >= 0
    decided = (votes > 0).sum(axis=1)
    ones = (votes == 2).sum(axis=1)
    q = np.where(decided > 0, (ones + 0.5) / (decided + 1.0), 0.5)
    q = np.where(known, gold, q)
    model = LabelModel(0.5, groups, [])
    for _ in range(EM_ROUNDS):
        weight = counts.sum()
        prior = float(np.clip((counts * q).sum() / weight, 1e-6, 1 - 1e-6)) if weight else 0.5
        tables = []
        for members in groups:
            outcome = sum(votes[:, m] * 3**i for i, m in enumerate(members))
            size = 3 ** len(members)
            table = np.stack([np.bincount(outcome, counts * (1 - q), size), np.bincount(outcome, counts * q, size)], axis=1) + SMOOTH / size
            tables.append(table / table.sum(axis=0, keepdims=True))
        model = LabelModel(prior, groups, tables)
        fresh = np.where(known, gold, model.posterior(votes))
        change = np.abs(fresh - q).max() if len(q) else 0.0
        q = fresh
        if change < 1e-10:
            break
    return model


def fit_label_model(votes: np.ndarray, gold: np.ndarray, counts: np.ndarray, names: list[str]) -> LabelModel:
    """Independent voters first; then correlated pairs within a class joined into groups, and fitted again."""
    m = votes.shape[1]
    model = _fit_groups(votes, gold, counts, [[j] for j in range(m)])
    q = np.where(gold >= 0, gold, model.posterior(votes)) if len(votes) else np.zeros(0)
    signed = np.where(votes == 2, 1.0, np.where(votes == 1, -1.0, 0.0))
    pairs = []
    for y_weight in (counts * q, counts * (1 - q)):
        total = y_weight.sum()
        if total <= 0:
            continue
        mean = (signed * y_weight[:, None]).sum(axis=0) / total
        centred = signed - mean
        cov = (centred * y_weight[:, None]).T @ centred / total
        sd = np.sqrt(np.clip(np.diag(cov), 0, None))
        for a, b in itertools.combinations(range(m), 2):
            if sd[a] > 0 and sd[b] > 0:
                pairs.append((abs(cov[a, b]) / (sd[a] * sd[b]), a, b))
    group_of = {j: [j] for j in range(m)}
    for corr, a, b in sorted(pairs, reverse=True):
        if corr <= CORRELATED:
            break
        ga, gb = group_of[a], group_of[b]
        if ga is not gb and len(ga) + len(gb) <= MAX_GROUP:
            ga.extend(gb)
            for j in gb:
                group_of[j] = ga
    groups = sorted({id(g): sorted(g) for g in group_of.values()}.values())
    model = _fit_groups(votes, gold, counts, groups) if len(groups) < m else model
    model.names = names
    return model


@dataclass
class ToxicityModel:
    label_model: LabelModel
    weights: np.ndarray | None  # WORD_CELLS word weights, then one per voter, then the bias


def _cells(words: Column) -> Column:
    """The distinct hashed cells of a text's words."""
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(WORD_CELLS)).cast("int")))


def _rows(cells: pa.Array, votes: pa.Array, n_voters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat cells, their row numbers, the value of each (1 / sqrt(cells of the row)) and the votes as -1, 0, 1."""
    offsets = cells.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = cells.values.to_numpy(zero_copy_only=False).astype(np.int64)[offsets[0] : offsets[-1]]
    row = np.repeat(np.arange(len(cells)), sizes)
    value = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
    signed = np.array([[{"0": 0.0, "1": -1.0, "2": 1.0}[c] for c in p] for p in votes.to_pylist()]).reshape(len(cells), n_voters)
    return flat, row, value, signed


def _logits(weights: np.ndarray, flat, row, value, signed) -> np.ndarray:
    n = len(signed)
    words = np.bincount(row, weights=weights[flat] * value, minlength=n)
    return words + signed @ weights[WORD_CELLS : WORD_CELLS + signed.shape[1]] + weights[-1]


def learn(flat, row, value, signed, target) -> np.ndarray:
    """Logistic regression on soft targets by AdaGrad steps over batches; the same for the same rows."""
    n, m = len(target), signed.shape[1]
    weights, squares = np.zeros(WORD_CELLS + m + 1), np.full(WORD_CELLS + m + 1, 1e-6)
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    weights[-1] = np.log(share / (1 - share))
    starts = np.searchsorted(row, np.arange(n + 1))
    for _ in range(EPOCHS):  # rows in the order of the hash of their id
        for lo in range(0, n, BATCH):
            batch = np.arange(lo, min(n, lo + BATCH))
            a, b = starts[batch[0]], starts[batch[-1] + 1]
            f, r, v = flat[a:b], row[a:b] - batch[0], value[a:b]
            z = np.bincount(r, weights=weights[f] * v, minlength=len(batch)) + signed[batch] @ weights[WORD_CELLS:-1] + weights[-1]
            slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[batch]) / len(batch)
            step = np.zeros_like(weights)
            np.add.at(step, f, slope[r] * v)
            step[WORD_CELLS:-1] = signed[batch].T @ slope
            step[-1] = slope.sum()
            step[:-1] += REGULARISE * weights[:-1]
            squares += step * step
            weights -= RATE * step / np.sqrt(squares)
    return weights


def _voter_names() -> list[str]:
    return [name for name, _ in voters(F.lit(""))] + ["shouting"]


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with the vote pattern and the hashed cells of each text in place of ``text``: ``fit`` and ``score`` take them
    instead of it. Written once, they spare both the scans of the texts."""
    found, _ = _with_votes(docs)
    return found.withColumn("_cells", _cells(F.col("_words"))).drop("_words", "text")


def _with_votes(docs: DataFrame, words: bool = True) -> tuple[DataFrame, list[str]]:
    if "text" not in docs.columns:  # they have their features
        return docs, _voter_names()
    lower = F.lower(F.coalesce(F.col("text"), F.lit("")))
    out = docs.withColumn("_words", _words(lower))
    found = voters(lower, F.col("_words")) + [("shouting", shouting(F.coalesce(F.col("text"), F.lit(""))))]
    names = [n for n, _ in found]
    code = F.concat_ws("", *[F.coalesce(v + 1, F.lit(0)).cast("string") for _, v in found])  # 0 abstain, 1 clean, 2 toxic
    out = out.withColumn("_pattern", code)
    return (out if words else out.drop("_words")), names


def _decode(patterns: list[str]) -> np.ndarray:
    return np.array([[int(c) for c in p] for p in patterns], np.int64).reshape(len(patterns), -1)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learns from the training ``docs`` (doc_id, text) and the ``labels`` (doc_id, toxic 0 or 1) among them.

    The label model counts the vote patterns of all training rows; the regression is fitted on at most ``fit_rows`` of
    them, the labelled ones first, then by hash of the id.
    """
    gold = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("gold"))
    ready = ["text"] if "text" in docs.columns else ["_pattern", "_cells"]
    docs = docs.select("doc_id", *ready)
    voted, names = _with_votes(docs, words=False)
    counted = voted.join(gold, "doc_id", "left").groupBy("_pattern", "gold").count().collect()  # at most 3^voters x 3 rows
    if not counted:
        return ToxicityModel(LabelModel(0.5, [[j] for j in range(len(names))], [np.full((3, 2), 1 / 3)] * len(names), names), None)
    votes = _decode([r["_pattern"] for r in counted])
    model = fit_label_model(
        votes, np.array([-1 if r["gold"] is None else r["gold"] for r in counted]), np.array([r["count"] for r in counted], float), names
    )
    distinct = sorted({r["_pattern"] for r in counted})
    posterior = model.posterior(_decode(distinct))
    spark = docs.sparkSession
    table = spark.createDataFrame([(p, float(q)) for p, q in zip(distinct, posterior)], "_pattern string, _posterior double")
    ids = docs.select("doc_id").distinct().join(gold, "doc_id", "left")
    chosen = ids.orderBy(F.col("gold").isNull(), F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    sample, _ = _with_votes(docs.join(F.broadcast(chosen), "doc_id"))  # fit_rows ids and labels
    soft = sample.join(broadcast_if_small(table), "_pattern").withColumn(
        "_posterior", F.when(F.col("gold").isNotNull(), F.col("gold").cast("double")).otherwise(F.col("_posterior"))
    )
    m = len(names)
    cells = F.col("_cells") if "_cells" in ready else _cells(F.col("_words"))
    rows = soft.select(cells.alias("cells"), "_pattern", "_posterior", F.xxhash64("doc_id").alias("order"))

    def to_weights(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("_posterior", "ascending")])  # whatever the order of arrival
        cells = table.column("cells").combine_chunks()
        flat, row, value, signed = _rows(cells, table.column("_pattern").combine_chunks(), m)
        weights = learn(flat, row, value, signed, table.column("_posterior").to_numpy())
        return pa.table({"weights": pa.array([weights.tolist()], pa.list_(pa.float64()))})

    found = rows.groupBy().applyInArrow(to_weights, "weights array<double>").collect()  # one task: fit_rows rows
    return ToxicityModel(model, np.array(found[0][0]) if found else None)



def score(docs: DataFrame, model: ToxicityModel, drop_text: bool = False) -> DataFrame:
    """Columns of ``docs`` and ``toxicity_score`` (0 to 1, higher: label 1 likelier), replaced if there is one."""
    docs = docs.drop("toxicity_score")
    ready = ["text"] if "text" in docs.columns else ["_pattern", "_cells"]
    kept = [c for c in docs.columns if not (drop_text and c == "text" or "text" not in ready and c in ready)]
    if model.weights is None:
        return docs.select(*kept, F.lit(0.5).alias("toxicity_score"))
    carried = fresh_name(docs, "_carried")  # other columns ride in one struct, clear of the working names
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias(carried), *ready)
    voted, names = _with_votes(work)
    rows = voted.select(carried, (F.col("_cells") if "_cells" in ready else _cells(F.col("_words"))).alias("cells"), "_pattern")
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)  # WORD_CELLS + voters + 1 numbers
    m = len(names)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            flat, row, value, signed = _rows(batch.column(1), batch.column(2), m)
            p = 1 / (1 + np.exp(-np.clip(_logits(weights, flat, row, value, signed), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], [carried, "toxicity_score"])

    schema = T.StructType([rows.schema[carried], T.StructField("toxicity_score", T.DoubleType())])
    return rows.mapInArrow(judge, schema).select(f"{carried}.*", "toxicity_score")
