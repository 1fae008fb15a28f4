"""Toxicity by a subsequence string kernel, Nystroem landmarks and a support vector machine.

Kernel. A word (with a mark at its start and end) is described by its ordered triples of
letters, gaps allowed up to a span, each weighted by decay ** (letters spanned), and scaled
by the norm that its length implies: the gap-weighted subsequence kernel of order three. A
letter put into an insult changes the weights of its triples, not their order; characters
that aren't letters are skipped, and runs of single letters count as one word.

Training. From a bounded sample of labelled texts. A labelled text says only that some
word in it is toxic, so training is by witnesses (multiple instances): landmarks come from
words whose letter runs occur in toxic texts far more often than in others; a linear SVM on
the Nystroem features of words starts from these and is fitted again with the words that
the last fit finds most toxic in each toxic text, and those it finds most toxic in clean
ones. Inserted-letter copies of the witnesses are added to the training words.

Scoring. The SVM is linear in the kernel's triples, so the landmarks fold into one table of
triple weights, and the score of a word is the sum of its triples' weights: exactly the
SVM's margin, in time linear in the text, for every word of the whole text. A text's margin
is that of its worst word, and half of that of the next, made a probability by a logistic
fit.

Defined cases: null and empty texts score as a text without words; labels that are null or
not 0 or 1 are ignored; repeated documents are scored row by row; without labels of both
kinds the score is 0; other columns are not read, and id, language and source never are
inputs of a score.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import give_back, mix64

SPAN, DECAY = 5, 0.5
#: Landmarks to begin with, and those that each further fit adds where the last one is wrong.
LANDMARKS, MORE = 192, 160
#: Labelled texts of each kind that training takes at most, and the longest one (characters).
SAMPLE, LONGEST = 1200, 12_000
THRESHOLD = 0.7
#: Share of clean texts, unseen in training, that may score above the threshold where both kinds overlap.
PASSED = 0.003
#: Weight of a text's second worst word beside its worst.
SECOND = 0.5
#: Log-likelihood ratio from which a letter run tells toxic texts from others.
TELLING = 25.0
LETTERS = 42
_EDGE, _SKIP = 0, 255
#: Characters that a scoring step holds at a time.
_STEP = 1 << 18


def _table() -> np.ndarray:
    """Classes of code points: 0 white space, 255 no letter, else one of the letters (others share)."""
    t = np.full(0x110000, _SKIP, np.uint8)
    for c in range(0x110000):
        if c < 0x3000 or 0x3400 <= c < 0xFB00:
            ch = chr(c)
            if ch.isspace():
                t[c] = _EDGE
            elif ch.isalpha():
                low = ch.lower()[0]
                t[c] = 1 + ord(low) - 97 if "a" <= low <= "z" else 27 + ord(low) % (LETTERS - 27)
    return t


_cache: dict[str, np.ndarray] = {}


def classes() -> np.ndarray:
    if "t" not in _cache:
        _cache["t"] = _table()
    return _cache["t"]


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all texts, edges around every word, and where each text begins.

    Edges are single; single letters that follow each other are one word.
    """
    raw = [classes()[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)] for t in texts]
    edge = np.zeros(1, np.uint8)
    parts = [x for r in raw for x in (edge, r)] + [edge]
    flat = np.concatenate(parts)
    of = np.repeat(np.arange(len(raw) + 1), [1 + len(r) for r in raw] + [1])
    keep = flat != _SKIP
    flat, of = flat[keep], of[keep]
    gap = flat == _EDGE
    first = np.append(True, of[1:] != of[:-1])
    keep = ~gap | first | np.append(True, ~gap[:-1])  # an edge after an edge goes, but for a text's own
    flat, of = flat[keep], of[keep]
    first = np.append(True, of[1:] != of[:-1])
    gap = flat == _EDGE
    lone = np.zeros(len(flat), bool)
    if len(flat) > 2:
        lone[1:-1] = gap[:-2] & gap[2:] & ~gap[1:-1]
        inner = np.zeros(len(flat), bool)
        inner[1:-1] = gap[1:-1] & lone[:-2] & lone[2:] & ~first[1:-1]
        flat, of, first = flat[~inner], of[~inner], first[~inner]
    return flat, np.flatnonzero(first)


def _pairs() -> list[tuple[int, int]]:
    return [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def _norms(longest: int) -> np.ndarray:
    """Square root of a word's kernel with itself, by its length with edges, triples taken as distinct."""
    n = np.arange(longest + 1)
    return np.sqrt(np.maximum(sum(np.maximum(n - b, 0) * DECAY ** (2 * (b + 1)) for _, b in _pairs()), 1e-9))


def triples(flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(positions, triple numbers, weight) for each shape of triple, within words."""
    gap = np.flatnonzero(flat == _EDGE)
    code = flat.astype(np.int32)
    following = np.searchsorted(gap, np.arange(len(flat)), side="right")
    reach = np.append(gap, len(flat) - 1)[following]  # the edge after each position
    at = np.arange(len(flat))
    for b in range(2, SPAN):
        i = np.flatnonzero(at + b <= reach)
        head, tail = code[i] * (LETTERS * LETTERS), code[i + b]
        for a in range(1, b):
            if len(i):
                yield i, head + code[i + a] * LETTERS + tail, DECAY ** (b + 1)


def margins(flat: np.ndarray, weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """(start, margin) of each word: its triples' weights over its norm."""
    total = np.zeros(len(flat), np.float32)
    for i, u, w in triples(flat):
        total[i] += w * weights[u]
    gap = np.flatnonzero(flat == _EDGE)
    start, stop = gap[:-1], gap[1:]
    real = stop - start > 1
    start, stop = start[real], stop[real]
    if not len(start):
        return start, np.zeros(0)
    sums = np.concatenate([np.zeros(1), np.cumsum(total, dtype=np.float64)])
    size = stop - start + 1
    longest = 4096
    return start, (sums[stop] - sums[start]) / _norms(longest)[np.minimum(size, longest)] + bias


class Model:
    """Weights of triples, bias and the logistic curve of a text's greatest margin."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float) -> None:
        self.weights, self.bias, self.slope, self.shift = weights.astype(np.float32), bias, slope, shift

    def worst(self, texts: list[str]) -> np.ndarray:
        """Greatest margin of each text, and SECOND times the next; the bias stands in for missing words."""
        out = np.full(len(texts), self.bias * (1 + SECOND))
        group: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if group and size + len(t) > _STEP:
                self._fill(texts, group, out)
                group, size = [], 0
            group.append(i)
            size += len(t)
        if group:
            self._fill(texts, group, out)
        return out

    def _fill(self, texts: list[str], group: list[int], out: np.ndarray) -> None:
        flat, begin = encode([texts[i] for i in group])
        start, m = margins(flat, self.weights, self.bias)
        if len(m):
            text = np.searchsorted(begin, start, side="right") - 1
            has, head = np.unique(text, return_index=True)
            best = np.maximum.reduceat(m, head)
            top = np.flatnonzero(m == np.repeat(best, np.diff(np.append(head, len(m)))))
            m[top[np.unique(text[top], return_index=True)[1]]] = self.bias
            at = np.array(group)[has]
            out[at] = best + SECOND * np.maximum(np.maximum.reduceat(m, head), self.bias)

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.worst(texts) - self.shift), -30, 30)))


# --------------------------------------------------------------------- training


def _clean(words: set[str]) -> set[str]:
    return {w for w in ("".join(c for c in w if c.isalpha()) for w in words) if len(w) > 1}


def _apart(bags: list[list[str]], hashes: int = 8) -> list[int]:
    """Texts without near copies of earlier ones: a group of copies would make all its words telling."""
    seen: list[set] = [set() for _ in range(hashes)]
    out = []
    for i, bag in enumerate(bags):
        rare = [w for w in bag if len(w) > 8] or bag  # common words say nothing about copies
        values = np.array([zlib.crc32(w.encode()) for w in rare] or [0], np.uint64)
        least = [int(x) for x in mix64(values[:, None] + np.arange(hashes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).min(0)]
        # few words, as in very short texts, agree by chance: these count as apart unless they are equal
        if sum(x in s for x, s in zip(least, seen)) < (hashes // 2 if len(rare) > 6 else hashes):
            out.append(i)
        for x, s in zip(least, seen):
            s.add(x)
    return out


def _kernel_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse triples of words: word numbers, triple numbers, weights over the word's norm."""
    flat, _ = encode([" ".join(words)])
    number = np.cumsum(flat == _EDGE) - 1
    w, u, v = [], [], []
    for i, triple, weight in triples(flat):
        w.append(number[i])
        u.append(triple)
        v.append(np.full(len(i), weight))
    w, u, v = map(np.concatenate, (w, u, v))
    size = np.bincount(number[flat != _EDGE], minlength=len(words)) + 2
    return w, u, v / _norms(int(size.max()))[size[w]]


def _features(words: list[str], table: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Kernel of each word with each landmark; table: (triples, landmarks), place: each triple's row."""
    out = np.zeros((len(words), table.shape[1]), np.float32)
    for at in range(0, len(words), 2000):
        part = words[at : at + 2000]
        flat, _ = encode([" ".join(part)])
        number = np.cumsum(flat == _EDGE) - 1
        for i, u, w in triples(flat):
            first = np.flatnonzero(np.append(True, number[i][1:] != number[i][:-1]))
            out[at + number[i][first]] += w * np.add.reduceat(table[place[u]], first, axis=0)
        size = np.bincount(number[flat != _EDGE], minlength=len(part)) + 2
        out[at : at + len(part)] /= _norms(int(size.max()))[size][:, None]
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 20.0, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, by damped Newton steps over the words within the margin."""
    # single precision for the words, double for the small systems
    xb = np.hstack([x.astype(np.float32, copy=False), np.ones((len(x), 1), np.float32)])
    y, weight = y.astype(np.float32), weight.astype(np.float32)
    ridge = np.eye(xb.shape[1])
    ridge[-1, -1] = 1e-3

    def loss(w: np.ndarray) -> float:
        return float(w @ ridge @ w + c * (weight * np.maximum(0, 1 - y * (xb @ w.astype(np.float32))) ** 2).sum(dtype=np.float64))

    w = np.zeros(xb.shape[1])
    now = loss(w)
    for _ in range(rounds):
        inside = y * (xb @ w.astype(np.float32)) < 1
        own = xb[inside]
        a = own * weight[inside, None]
        step = np.linalg.solve(ridge + c * (a.T @ own).astype(np.float64), c * (a.T @ y[inside]).astype(np.float64)) - w
        del own, a
        part = 1.0
        while (then := loss(w + part * step)) > now and part > 1e-3:
            part /= 2
        if now - then < 1e-6 * now:
            break
        w, now = w + part * step, then
    return w[:-1], float(w[-1])


def _inserted(word: str, rng: np.random.Generator, letters: list[str]) -> str:
    i = int(rng.integers(1, len(word)))
    return word[:i] + letters[int(rng.integers(len(letters)))] + word[i:]


def train(texts: list[str], toxic: list[int], seed: int = 7) -> Model:
    """Fits the model to labelled texts; a third of the clean ones only sets the threshold."""
    kept_back = [i for n, i in enumerate(i for i, k in enumerate(toxic) if not k) if n % 3 == 2]
    others = [texts[i] for i in kept_back]
    back = set(kept_back)
    texts, toxic = [t for i, t in enumerate(texts) if i not in back], [k for i, k in enumerate(toxic) if i not in back]
    y = np.array(toxic, np.int64)
    bags = [sorted(_clean(set(t.lower().split()))) for t in texts]
    apart = _apart(bags)
    texts, bags, y = [texts[i] for i in apart], [bags[i] for i in apart], y[apart]
    toxic = y.tolist()
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(LETTERS**3), -1.0, 0.0, -1.0) if not len(y) or not y.max() else Model(np.zeros(LETTERS**3), 1.0, 10.0, 0.0)
    rng = np.random.default_rng(seed)
    n_pos, n_neg = int(y.sum()), int((1 - y).sum())
    # letter runs (with edges) that tell toxic texts from others, each counted once a text
    def runs(word: str) -> set[int]:
        """Letter runs by their CRC-32, which keeps the counts of a million of them small."""
        marked = f"^{word}$".encode()
        return {zlib.crc32(marked[i : i + k]) for k in (4, 5, 6) for i in range(len(marked) - k + 1)} | {zlib.crc32(marked)}

    known = [Counter(), Counter()]
    for bag, label in zip(bags, toxic):
        known[label].update(bag)
    each = [np.fromiter(set().union(*map(runs, bag)), np.uint32) for bag, label in zip(bags, toxic) if label and bag]
    found, times = np.unique(np.concatenate(each or [np.zeros(0, np.uint32)]), return_counts=True)
    seen = [Counter(), Counter(dict(zip(found[times > 1].tolist(), times[times > 1].tolist())))]
    del each, found, times
    for bag, label in zip(bags, toxic):
        if not label:  # only runs that toxic texts share are counted
            seen[0].update({g for w in bag for g in runs(w) if g in seen[1]})
    share = n_pos / (n_pos + n_neg)

    def telling(k: int, c: int) -> float:
        """Log-likelihood ratio of k toxic and c clean texts against the share of toxic texts; 0 if fewer are toxic."""
        if k <= (k + c) * share:
            return 0.0
        return 2 * (k * np.log(k / ((k + c) * share)) + (c * np.log(c / ((k + c) * (1 - share))) if c else 0.0))

    odds = {g: telling(k, seen[0][g]) for g, k in seen[1].items()}
    power_of: dict[str, float] = {}

    def power(word: str) -> float:
        if word not in power_of:
            power_of[word] = max((odds.get(g, 0.0) for g in runs(word)), default=0.0)
        return power_of[word]

    # a toxic text's witnesses: its words with telling runs, but for words that clean texts have
    sure = min(TELLING, max(odds.values(), default=0.0) / 2)
    witness: Counter = Counter()
    for bag, label in zip(bags, toxic):
        witness.update(w for w in bag if label and not known[0][w] and power(w) >= sure)
    clean = sorted(known[0], key=lambda w: (-power(w), w))
    sample = clean[:3000] + [clean[i] for i in sorted(rng.choice(len(clean), min(5000, len(clean)), replace=False).tolist())]
    sample = list(dict.fromkeys(sample))
    # landmarks: telling words of all kinds, no two alike, and clean words near to them
    if not witness:
        return Model(np.zeros(LETTERS**3), 0.0, 0.0, np.log(1 / share - 1))
    pool = sorted(witness, key=lambda w: (-witness[w] * power(w), w))[:1500]
    landmarks = _spread(pool, LANDMARKS * 2 // 3) + _spread(clean[:1500], LANDMARKS // 3)
    letters = sorted({c for x in clean[:500] for c in x})
    positive = list(witness)
    beta, bias, table = np.zeros(0), 0.0, np.zeros(LETTERS**3)
    for turn in range(4):
        grown = positive + [_inserted(p, rng, letters) for p in positive if len(p) > 3]
        words = grown + sample
        label = np.array([1.0] * len(grown) + [-1.0] * len(sample))
        # a witness counts by how many texts have it, its inserted copies less
        often = np.array([max(1, witness[w]) for w in positive] + [0.2 * max(1, witness[w]) for w in positive if len(w) > 3], float)
        weight = np.concatenate([often * len(words) / (2 * often.sum()), np.full(len(sample), len(words) / (2 * len(sample)))])
        w, u, v = _kernel_rows(landmarks)
        own = np.unique(u)  # the landmarks' triples; row 0 stands for all others
        place = np.zeros(LETTERS**3, np.int32)
        place[own] = np.arange(1, len(own) + 1)
        dense = np.zeros((len(own) + 1, len(landmarks)), np.float32)
        np.add.at(dense, (place[u], w), v)
        values, vectors = np.linalg.eigh((dense.T @ dense).astype(np.float64))
        good = values > 1e-5 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        x = _features(words, dense, place) @ root.astype(np.float32)
        beta, bias = _svm(x, label, weight)
        table = (dense @ (root @ beta))[place]
        if turn == 3:
            break
        # witnesses again: each toxic text's worst word, and the worst ones of clean texts
        every = sorted(known[1] | known[0])
        score = dict(zip(every, _word_margins(every, table, bias).tolist()))
        again: Counter = Counter(w for w in witness if score[w] > -0.5)
        for bag, lab in zip(bags, toxic):
            fit = [w for w in bag if lab and not known[0][w]]
            if fit and score[top := max(fit, key=lambda w: (score[w], w))] > 0:
                again[top] += 1
        positive = list(again) or positive
        hard = sorted(known[0], key=lambda w: (-score[w], w))[:2500]
        sample = list(dict.fromkeys(hard + sample))[:9000]
        # landmarks where the fit is wrong, clean words first
        low = sorted(positive, key=lambda w: (score[w], w))[:200]
        landmarks = _spread(landmarks + hard[:600], len(landmarks) + MORE * 3 // 4, 0.9)
        landmarks = _spread(landmarks + low, len(landmarks) + MORE // 4, 0.9)
    raw = Model(table, bias, 1.0, 0.0)
    slope, shift = _logistic(raw.worst(others or texts), raw.worst([t for t, k in zip(texts, toxic) if k]))
    return Model(table, bias, slope, shift)


def _spread(pool: list[str], most: int, alike: float = 0.8) -> list[str]:
    """Words in order of the pool, leaving out those alike to one already taken."""
    if not pool:
        return []
    w, u, v = _kernel_rows(pool)
    rows = defaultdict(dict)
    for a, b, c in zip(w.tolist(), u.tolist(), v.tolist()):
        rows[a][b] = rows[a].get(b, 0.0) + c
    taken: list[int] = []
    for i in range(len(pool)):
        if len(taken) == most:
            break
        own = rows[i]
        if all(sum(x * rows[j].get(t, 0.0) for t, x in own.items()) < alike for j in taken):
            taken.append(i)
    return [pool[i] for i in taken]


def _word_margins(words: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    out = []
    for at in range(0, len(words), 20_000):
        flat, _ = encode([" ".join(words[at : at + 20_000])])
        out.append(margins(flat, table.astype(np.float32), bias)[1])
    return np.concatenate(out)


def _logistic(clean: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the curve; a score of 0.7 lies between clean margins, of texts that
    training didn't see, and toxic ones, and never below what but few clean texts pass."""
    low, high = np.quantile(clean, 1 - PASSED), np.quantile(toxic, 0.03)
    at = max(low, (low + high) / 2)
    slope = 3.0 / max(abs(high - low) / 2, 0.25)
    return float(slope), float(at - np.log(0.7 / 0.3) / slope)


# ------------------------------------------------------------------------ Spark


def held_out(doc_id: Column) -> Column:
    """The fold whose labels no model learns from."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, each: int = SAMPLE, longest: int = LONGEST) -> tuple[list[str], list[int]]:
    """Texts and labels for training: at most `each` of a kind, by hash of id, none longer than `longest`.

    Ids are chosen first, from the labels alone, so the texts of a few thousand rows reach
    the driver, a bounded amount.
    """
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    some = [usable.filter(F.col("toxic") == k).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * each) for k in (0, 1)]
    chosen = {}
    for part in some:
        for r in part.collect():  # at most 2 * each rows
            chosen.setdefault(r["doc_id"], r["toxic"])
    if not chosen:
        return [], []
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    picked = picked.filter(F.col("doc_id").isin(list(chosen)) & (F.length("text") <= longest)).dropDuplicates(["doc_id", "text"])
    rows = sorted(((r["doc_id"], r["text"]) for r in picked.collect()), key=lambda r: (hash_of(r[0]), r))
    texts, kinds, count, had = [], [], [0, 0], set()
    for doc_id, text in rows:
        k = chosen[doc_id]
        if count[k] < each and text not in had:
            had.add(text)
            count[k] += 1
            texts.append(text)
            kinds.append(k)
    return texts, kinds


def hash_of(x: int) -> int:
    return (x * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % (1 << 64) >> 11


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    return train(*labelled_sample(docs, labels))


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                score = model.score([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64())], names=["row", "score"])
            give_back()

    return run


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns in keep, and score; the model is one table of 74,088 weights (0.3 MB)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(shared), f"row {kind}, score double")
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("score"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest per document that the query returns."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels), ["doc_id"])
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, all their columns unchanged."""
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole"), "text")
    return score(whole, model, ["whole"]).filter(F.col("score") < threshold).select(*[F.col(f"whole.`{c}`").alias(c) for c in names])
