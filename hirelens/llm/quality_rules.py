"""Operator 5, quality rules: a linear-chain conditional random field labels each line.

Lines are content or boilerplate; Viterbi decoding picks the likeliest sequence
of labels for a document and the share of words in content lines decides
whether it stays. Base rules on counts go first.

No line is labelled in the data, documents are. So the labels of lines stay
hidden in training, and the label of a document only bounds their share: of a
good document CONTENT_OF_GOOD of the lines or more are expected to be content, of a
bad one CONTENT_OF_BAD or less. Each round takes the distribution over label
sequences that is closest to the field's own within these bounds (posterior
regularization: one bias for all lines of a document), and moves the field
towards it. It starts from START_WEIGHTS, the evidence that a single line gives, and is
held near them; without labels of both kinds they apply as they are. So a document may get both labels.

The sample is bounded: SAMPLE_DOCS documents of each label, each with all of its lines.

Edge cases: a null, empty or blank text has no words, so the base rules reject
it; an empty table gives an empty result. Very long texts are judged whole, in memory in
proportion to the longest. Of equally likely labels content is taken, and a content share of just the
least one keeps a document. Rows are judged one by one, so repeated rows get equal results; of repeated
labels of one doc_id the better one counts, of repeated documents the text that is first in order
is learned from. Every input column but a clashing result name is carried through as it is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import small, text_bytes

#: Bound of the training sample: documents of each label.
SAMPLE_DOCS = 1500
#: Lines, with padding to the longest document, that are fitted at once; a longer document is fitted alone.
FIT_LINES = 60_000
#: A document stays if so large a part of its words is in content lines.
MIN_CONTENT = 0.5
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"

CUES = (b"cookie", b"copyright", b"all rights reserved", b"subscribe", b"sign in", b"log in", b"click here", b"privacy policy", b"terms of")
FEATURES = ("bias", "symbols", "pipes", "capitals", "marks", "digits", "same_word", "few_words", "ends", "repeated", "cue", "long_words")
#: Rows: content, boilerplate. What symbols, repeated words and the like say of a line before anything is learned.
START_WEIGHTS = {
    "emit": [[0.2, -1.0, -0.5, -0.5, -0.75, -0.25, -1.0, -0.1, 0.1, -0.1, -0.25, 0.0], [-0.2, 1.0, 0.5, 0.5, 0.75, 0.25, 1.0, 0.1, -0.1, 0.1, 0.25, 0.0]],
    "step": [[0.15, -0.15], [-0.15, 0.15]],
}
#: Bounds on the expected share of content lines.
CONTENT_OF_GOOD, CONTENT_OF_BAD = 0.8, 0.4
ROUNDS, RATE, HOLD = 150, 0.5, 0.002


def features(lines: list[bytes]) -> np.ndarray:
    """A row of FEATURES for each line; shares are of the line's bytes or words."""
    seen: Counter[bytes] = Counter(lines)
    rows = np.zeros((len(lines), len(FEATURES)), np.float32)
    for k, line in enumerate(lines):
        words = line.split()
        n, m = max(1, len(line)), max(1, len(words))
        low = line.lower()
        rows[k] = (
            1,
            min(1.0, 4 * (len(line) - len(line.translate(None, SYMBOLS))) / n),
            min(1.0, 4 * line.count(b"|") / m),
            (len(line) - len(line.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / n,
            min(1.0, line.count(b"!") / m),
            (len(line) - len(line.translate(None, b"0123456789"))) / n,
            1 - len(set(words)) / m if len(words) > 3 else 0,
            len(words) < 5,
            line.rstrip()[-1:] in (b".", b"?", b'"'),
            seen[line] > 1,
            any(c in low for c in CUES),
            min(1.0, max(0.0, n / m - 10) / 20),
        )
    return rows


def viterbi(rows: np.ndarray, emit: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Likeliest labels, 0 content and 1 boilerplate; a tie goes to content."""
    score = rows @ emit.T
    n = len(score)
    if not n:
        return np.empty(0, np.int8)
    (s00, s01), (s10, s11) = step.tolist()
    a, b = score[0].tolist()
    back = []
    for x, y in score[1:].tolist():
        from_a, from_b = b + s10 > a + s00, b + s11 > a + s01
        back.append((from_a, from_b))
        a, b = (b + s10 if from_a else a + s00) + x, (b + s11 if from_b else a + s01) + y
    labels = np.empty(n, np.int8)
    at = int(b > a)
    for k in range(n - 1, -1, -1):
        labels[k] = at
        if k:
            at = int(back[k - 1][at])
    return labels


def batches_of(documents: list[tuple[np.ndarray, int]], most: int = FIT_LINES) -> list[list[tuple[np.ndarray, int]]]:
    """documents by length, in groups of at most so many lines when padded to their longest."""
    groups: list[list[tuple[np.ndarray, int]]] = []
    for d in sorted(documents, key=lambda d: len(d[0])):
        if not groups or (len(groups[-1]) + 1) * len(d[0]) > most:
            groups.append([])
        groups[-1].append(d)
    return groups


def padded(documents: list[tuple[np.ndarray, int]], share: dict[int, float]) -> tuple[np.ndarray, ...]:
    """Feature rows, where there are any, labels, and the weight of a line of each document."""
    length, n = max(len(r) for r, _ in documents), len(documents)
    x = np.zeros((n, length, len(FEATURES)), np.float32)
    on = np.zeros((n, length), bool)
    y = np.array([label for _, label in documents])
    for k, (rows, _) in enumerate(documents):
        x[k, : len(rows)], on[k, : len(rows)] = rows, True
    return x, on, y, np.array([share[label] for _, label in documents]) / on.sum(1)


def marginals(content: np.ndarray, other: np.ndarray, on: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of content by line, and of each step between lines, (documents, lines - 1, from, to)."""
    n, length = content.shape
    ahead, behind = np.zeros((2, length, n)), np.zeros((2, length, n))
    score = np.stack([content.T, other.T]) * on.T
    ahead[:, 0] = score[:, 0]
    for t in range(1, length):
        a, b = ahead[:, t - 1]
        for k in (0, 1):
            ahead[k, t] = np.where(on[:, t], np.logaddexp(a + step[0, k], b + step[1, k]) + score[k, t], ahead[k, t - 1])
    for t in range(length - 2, -1, -1):
        a, b = behind[:, t + 1] + score[:, t + 1]
        for k in (0, 1):
            behind[k, t] = np.where(on[:, t + 1], np.logaddexp(step[k, 0] + a, step[k, 1] + b), behind[k, t + 1])
    total = np.logaddexp(ahead[0, -1], ahead[1, -1])
    at = np.exp(ahead[0] + behind[0] - total) * on.T
    after = score[:, 1:] + behind[:, 1:] - total
    edge = np.stack([[np.exp(np.minimum(0, ahead[i, :-1] + step[i, j] + after[j])) * (on.T[1:] & on.T[:-1]) for j in (0, 1)] for i in (0, 1)])
    return at.T, edge.transpose(3, 2, 0, 1)


def gradient(x: np.ndarray, on: np.ndarray, label: np.ndarray, weight: np.ndarray, bias: np.ndarray, emit: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the documents of a group add to the gradients of emit and step; moves their bias towards the bounds."""
    score = x @ emit.T
    own, own_edge = marginals(score[..., 0], score[..., 1], on, step)
    wanted, wanted_edge = marginals(score[..., 0] + bias[:, None], score[..., 1], on, step)
    share = np.clip(wanted.sum(1) / on.sum(1), 1e-6, 1 - 1e-6)
    bound = np.where(label == 0, CONTENT_OF_GOOD, CONTENT_OF_BAD)
    bias += 0.7 * (np.log(bound / (1 - bound)) - np.log(share / (1 - share)))
    bias[:] = np.clip(bias, np.where(label == 0, 0, -30), np.where(label == 0, 30, 0))  # a bound that holds pushes nowhere
    miss = np.einsum("nt,ntf->f", (wanted - own) * weight[:, None], x)
    return np.stack([miss, -miss]), np.einsum("ntij,n->ij", wanted_edge - own_edge, weight)


def fit(documents: list[tuple[np.ndarray, int]], rounds: int = ROUNDS, rate: float = RATE) -> dict:
    """Weights from (feature rows, label) chains, labels 0 good and 1 bad."""
    documents = [(rows, label) for rows, label in documents if len(rows)]
    counts = Counter(label for _, label in documents)
    if len(counts) < 2:
        return START_WEIGHTS
    groups = [padded(d, {label: 0.5 / n for label, n in counts.items()}) for d in batches_of(documents)]
    biases = [np.zeros(len(label)) for _, _, label, _ in groups]
    first_emit, first_step = np.array(START_WEIGHTS["emit"]), np.array(START_WEIGHTS["step"])
    emit, step = first_emit.copy(), first_step.copy()
    for _ in range(rounds):
        found = [gradient(*group, bias, emit, step) for group, bias in zip(groups, biases, strict=True)]
        emit += rate * 8 * sum(e for e, _ in found) - HOLD * (emit - first_emit)
        step += rate * sum(s for _, s in found) - HOLD * (step - first_step)
    return {"emit": emit.tolist(), "step": step.tolist()}


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    size = len(number)
    if size == len(words):
        return 0
    pairs = ids[:-1] * size + ids[1:]
    if size > 1_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    codes = pairs[:-1] * size + ids[2:]
    order = np.argsort(codes, kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    if not hit.any():
        return 0
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + n] |= hit
    return int(covered.sum())


def judge(text: bytes | None, emit: np.ndarray, step: np.ndarray, min_content: float) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept."""
    text = text or b""
    words = text.split()
    n = len(words)
    chars = sum(map(len, words)) - (len(text) - len(text.decode(errors="replace")))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeats > 50 * n
    share = 0.0
    if n:
        sizes = np.array([len(x.split()) for x in lines])
        share = float(sizes[viterbi(features(lines), emit, step) == 0].sum() / n)
    return n, chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeats, failed, share, not failed and share >= min_content


RESULT = {"n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "content_share": "double", "kept": "boolean"}
_TYPES = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}


def assess(docs: DataFrame, weights: dict, min_content: float = MIN_CONTENT) -> DataFrame:
    """docs with the columns of RESULT; a result column replaces an input column of its name."""
    carried = [f for f in docs.schema.fields if f.name not in RESULT]
    names = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, step = np.array(weights["emit"]), np.array(weights["step"])
        for batch in small(batches):
            found = [judge(x, emit, step, min_content) for x in text_bytes(batch.column("text"))]
            columns = zip(*found, strict=True) if found else [[]] * len(RESULT)
            added = [pa.array(list(c), _TYPES[t]) for c, t in zip(columns, RESULT.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), *added], names=[*names, *RESULT])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), *(f"{k} {t}" for k, t in RESULT.items())])
    return docs.select(*names).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """Weights from all lines of at most sample_docs documents of each label, picked by a hash of doc_id."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    picked = [known.where(f"quality = {q}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for q in (0, 1)]
    few = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * sample_docs rows of two numbers
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(few, "doc_id")
    chosen = chosen.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # so that the bound holds for rows too

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made = [features([x for x in (t or b"").split(b"\n") if x.strip()]) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array([m.tobytes() for m in made], pa.binary())], names=["doc_id", "quality", "f"])

    got = chosen.mapInArrow(run, "doc_id bigint, quality int, f binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.quality, r.f))
    return fit([(np.frombuffer(r.f, np.float32).reshape(-1, len(FEATURES)), 1 - r.quality) for r in got])
