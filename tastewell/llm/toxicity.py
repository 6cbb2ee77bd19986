"""Toxicity of whole texts: a subsequence string kernel, Nyström landmarks, a support vector machine.

The kernel of two words sums over the letter triples that both hold in this order, gaps allowed, each
weighted by a decay for the letters it spans; so an insult with letters put in between keeps most of its
value. Landmarks are pieces of words that mark toxic training texts. A word's kernel values to the landmarks,
divided by the norms, times the inverse root of the landmarks' own kernel matrix, are its Nyström features,
on which a linear machine with squared hinge loss is trained. A text's margin is the largest of its words',
as one toxic word makes a text toxic; a logistic curve over it gives the score.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 6000  # labelled rows that are learned from, at most half of them toxic
LANDMARKS = 96  # more only for toxic texts that have none otherwise
PIECES = (5, 7, 9, 11)  # letters of a landmark, with the marks of a word's ends
LEAST_TEXTS = (4, 3, 2)  # toxic texts that hold it; fewer for texts that are left without any
LIKE = 0.6  # kernel value of pieces of which one is enough
PIECES_PER_STEP = 1024
LEAST_ODDS = 2.5  # log odds of toxic against clean texts
PENALTY = 1e-4
ROUNDS = 4  # of choosing toxic words and training
TRIPLE = 3
DECAY = 0.7
SPAN = 7  # letters that a triple may span
WORD = 18  # longer words are read in overlapping windows of this length
LEAST_VALUE = 0.25  # smaller normalised kernel values count as none
TEXT_BYTES = 4 << 20  # worked on at a time
WORDS_PER_STEP = 2048
KNOWN_WORDS = 400_000  # whose margins a task keeps
DIGITS = str.maketrans("013457", "oieast")  # digits that stand for letters inside words


# A plain memory: a cached function would be shipped by its name, which executors do not know.
_triples: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i < j < k) of all triples of a word of this length within the span, and their weights."""
    if length not in _triples:
        places = [(i, j, k) for i in range(length) for k in range(i + 2, min(length, i + SPAN)) for j in range(i + 1, k)]
        places = np.array(places, np.int64).reshape(-1, 3)
        _triples[length] = places, DECAY ** (places[:, 2] - places[:, 0] + 1)
    return _triples[length]


class Kernel:
    """Landmarks and their triples; letters that no landmark has are class zero."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(landmarks))))}
        self.size = len(letters) + 1
        self.classes = np.zeros(max((ord(c) for c in letters), default=0) + 2, np.int32)
        for c, i in letters.items():
            self.classes[ord(c)] = i
        # By triple: the landmarks that hold it and its weight in each, one after the other.
        weights: dict[tuple[int, int], float] = {}
        for m, landmark in enumerate(landmarks):
            places, decays = triples(len(landmark))
            for (i, j, k), w in zip(places.tolist(), decays.tolist(), strict=True):
                code = (letters[landmark[i]] * self.size + letters[landmark[j]]) * self.size + letters[landmark[k]]
                weights[code, m] = weights.get((code, m), 0.0) + w
        order = sorted(weights)
        codes = np.array([c for c, _ in order], np.int64)
        self.owner = np.array([m for _, m in order], np.int64)
        self.weight = np.array([weights[key] for key in order])
        self.starts = np.searchsorted(codes, np.arange(self.size**TRIPLE + 1))
        self.held = np.diff(self.starts) > 0
        self.norms = np.sqrt(np.bincount(self.owner, weights=self.weight**2, minlength=len(landmarks))) if landmarks else np.zeros(0)

    def values(self, words: list[str]) -> np.ndarray:
        """Normalised kernel of every word with every landmark; small values are zero."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        parts: dict[int, tuple[list[int], list[str]]] = {}
        for at, word in enumerate(words):
            for start in range(0, max(1, len(word) - WORD // 2), WORD // 2):
                piece = word[start : start + WORD]
                if len(piece) >= TRIPLE:
                    rows, pieces = parts.setdefault(len(piece), ([], []))
                    rows.append(at)
                    pieces.append(piece)
        width = len(self.landmarks)
        for length, (rows, pieces) in parts.items():
            places, decays = triples(length)
            least = LEAST_VALUE * np.sqrt((decays**2).sum())
            for start in range(0, len(pieces), WORDS_PER_STEP):
                block = pieces[start : start + WORDS_PER_STEP]
                points = np.frombuffer("".join(block).encode("utf-32-le"), np.uint32).reshape(len(block), length)
                chars = self.classes[np.minimum(points, len(self.classes) - 1)]
                codes = (chars[:, places[:, 0]] * np.int32(self.size) + chars[:, places[:, 1]]) * np.int32(self.size) + chars[:, places[:, 2]]
                word, triple = np.nonzero(self.held[codes])
                code = codes[word, triple]
                begin, many = self.starts[code], self.starts[code + 1] - self.starts[code]
                entry = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
                cell = np.repeat(word * width, many) + self.owner[entry]
                sums = np.bincount(cell, weights=self.weight[entry] * np.repeat(decays[triple], many), minlength=len(block) * width)
                scaled = sums.reshape(len(block), width) / self.norms
                # A word's own kernel is at least the sum of its squared weights: words that stay small are left.
                near = np.flatnonzero(scaled.max(1) >= least)
                if len(near):
                    scaled = scaled[near] / np.sqrt(_own_kernel(points[near], places, decays))[:, None]
                    target = np.array(rows[start : start + WORDS_PER_STEP])[near]
                    np.maximum.at(out, target, np.where(scaled >= LEAST_VALUE, scaled, 0).astype(np.float32))
        return out


def _own_kernel(points: np.ndarray, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Kernel of each word with itself; equal triples add up before they are squared."""
    p = points.astype(np.int64)
    codes = (p[:, places[:, 0]] << 42) | (p[:, places[:, 1]] << 21) | p[:, places[:, 2]]
    order = np.argsort(codes, axis=1)
    codes = np.take_along_axis(codes, order, 1)
    values = weights[order]
    new = np.ones(codes.shape, bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
    sums = np.add.reduceat(values.ravel(), np.flatnonzero(new.ravel()))
    owner = np.nonzero(new)[0]
    return np.bincount(owner, weights=sums**2, minlength=len(points))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts one after the other and the row of each.

    Letters and digits only, in lower case, so that signs put between letters do not matter; single letters in
    a row are one word more.
    """
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL\pM\pN\s]+", "")
    lists = pc.utf8_split_whitespace(plain)
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    words = lists.flatten()
    single = pc.equal(pc.utf8_length(words), 1).to_numpy(zero_copy_only=False)
    if single.sum() >= TRIPLE:
        places = np.flatnonzero(single)
        new = np.concatenate([[True], (np.diff(places) > 1) | (np.diff(rows[places]) > 0)])
        runs = np.split(places, np.flatnonzero(new)[1:])
        long = [r for r in runs if len(r) >= TRIPLE]
        if long:
            joined = ["".join(words.take(pa.array(r)).to_pylist()) for r in long]
            words = pa.concat_arrays([words, pa.array(joined, words.type)])
            rows = np.concatenate([rows, [rows[r[0]] for r in long]])
    return words, rows


def _normal(words: list[str]) -> list[str]:
    """Words between marks of their start and end; accents joined to their letters, digits inside words read as letters."""
    joined = [unicodedata.normalize("NFC", w) for w in words]
    return [f"<{w if w.isalpha() else w.translate(DIGITS)}>" if not w.isdigit() else "" for w in joined]


def _texts_with(texts: list[str], toxic: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Distinct words, and in how many texts of each label (clean, toxic) each stands."""
    totals: list[Counter] = [Counter(), Counter()]
    for start in range(0, len(texts), 256):
        words, rows = words_of(pa.array(texts[start : start + 256], pa.string()))
        coded = words.dictionary_encode()
        pairs = np.unique(rows * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False))
        row, word = np.divmod(pairs, len(coded.dictionary) + 1)
        names = np.array(_normal(coded.dictionary.to_pylist()), object)
        for label in (0, 1):
            counts = np.bincount(word[toxic[start : start + 256][row] == label], minlength=len(names))
            totals[label].update(dict(zip(names[counts > 0].tolist(), counts[counts > 0].tolist(), strict=True)))
    names = sorted(totals[0] | totals[1])
    return names, np.array([[totals[0][n], totals[1][n]] for n in names], np.int64).reshape(-1, 2)


def choose_landmarks(words: list[str], counts: np.ndarray, n_clean: int, n_toxic: int, most: int = LANDMARKS, held: tuple[np.ndarray, np.ndarray] | None = None) -> list[str]:
    """Pieces of words that toxic texts hold and few others do, unlike each other.

    A piece counts once for each word that holds it and each text that holds the word. ``held`` has the toxic
    texts and the words they hold: beyond ``most`` landmarks, and at lower counts, pieces are taken only if they
    stand in a toxic text that has no landmark yet.
    """
    pieces = lambda w: {w[i : i + n] for n in PIECES for i in range(len(w) - n + 1)}
    marks: Counter = Counter()
    for word, (clean, bad) in zip(words, counts.tolist(), strict=True):
        # A word that is no rarer in clean texts cannot mark toxic ones.
        if bad and bad * n_clean > clean * n_toxic:
            marks.update(dict.fromkeys(pieces(word), bad))
    marks = Counter({p: c for p, c in marks.items() if c >= min(LEAST_TEXTS)})
    plain: Counter = Counter()
    for word, (clean, _) in zip(words, counts.tolist(), strict=True):
        if clean:
            plain.update({p: clean for p in pieces(word) if p in marks})
    scored = []
    for piece, c in marks.items():
        odds = np.log((c + 0.5) / (n_toxic + 1)) - np.log((plain[piece] + 0.5) / (n_clean + 1))
        if odds > LEAST_ODDS:
            # Longer pieces of the same strength say more.
            level = next(k for k, least in enumerate(LEAST_TEXTS) if c >= least)
            scored.append((level, -(odds * c * (1 + 0.1 * len(piece))), piece))
    scored.sort()
    wanted = {p for _, _, p in scored}
    holders: dict[str, list[int]] = {p: [] for p in wanted}
    for at, word in enumerate(words):
        if counts[at, 1]:
            for p in pieces(word) & wanted:
                holders[p].append(at)
    text, word = held if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.argsort(word, kind="stable")
    text, starts = text[order], np.searchsorted(word[order], np.arange(len(words) + 1))
    bare = np.zeros(int(text.max(initial=-1)) + 1, bool)
    bare[text] = True
    chosen: list[str] = []
    for start in range(0, len(scored), PIECES_PER_STEP):
        part = scored[start : start + PIECES_PER_STEP]
        like = Kernel(chosen).values([p for _, _, p in part]).max(1) if chosen else np.zeros(len(part))
        fresh, kernel = len(chosen), None
        for (level, _, piece), value in zip(part, like.tolist(), strict=True):
            texts = np.concatenate([text[starts[w] : starts[w + 1]] for w in holders[piece]])
            if (level or len(chosen) >= most) and not bare[texts].any():
                continue
            if value < LIKE and len(chosen) > fresh:
                kernel = kernel or Kernel(chosen[fresh:])
                value = kernel.values([piece]).max()
            if value < LIKE:
                chosen.append(piece)
                kernel = None
            bare[texts] = False
        if len(chosen) >= most and not bare.any():
            break
    return chosen


class Model:
    """What scoring needs: some thousand numbers, whatever the corpus."""

    def __init__(self, kernel: Kernel, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.kernel, self.weights, self.bias, self.slope, self.offset = kernel, weights, bias, slope, offset
        self.known: dict[str, float] = {}

    def word_margins(self, words: list[str]) -> np.ndarray:
        return self.kernel.values(_normal(words)) @ self.weights + self.bias

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Largest margin among the words of each text; texts without words have that of a word unlike any landmark."""
        words, rows = words_of(texts)
        coded = words.dictionary_encode()
        out = np.full(len(texts), self.bias)
        if not len(coded.dictionary) or not self.kernel.landmarks:
            return out
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, new = {}, distinct
        self.known.update(zip(new, self.word_margins(new).tolist(), strict=True))
        margin = np.fromiter((self.known[w] for w in distinct), float, len(distinct))
        np.maximum.at(out, rows, margin[coded.indices.to_numpy(zero_copy_only=False)])
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -50, 50)))


def _hinge(x: np.ndarray, y: np.ndarray, balance: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights and bias of least squared hinge loss, by Newton's steps: least squares over the rows inside the margin."""
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = PENALTY * np.diag([1.0] * x.shape[1] + [1e-6])
    w, active = np.zeros(x1.shape[1]), np.ones(len(x), bool)
    for _ in range(rounds):
        part = x1[active] * balance[active][:, None]
        w = np.linalg.solve(part.T @ x1[active] + ridge, part.T @ y[active])
        now = y * (x1 @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def _words_held(texts: list[str], place: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Text and word of every distinct pair, words by their place."""
    bags = []
    for start in range(0, len(texts), 256):
        words, rows = words_of(pa.array(texts[start : start + 256], pa.string()))
        coded = words.dictionary_encode()
        index = np.array([place[n] for n in _normal(coded.dictionary.to_pylist())], np.int64)
        pairs = np.unique(np.stack([rows + start, index[coded.indices.to_numpy(zero_copy_only=False)]]), axis=1) if len(words) else np.zeros((2, 0), np.int64)
        bags.append(pairs)
    row, word = np.concatenate(bags, axis=1)
    return row, word


def train(texts: list[str], toxic: np.ndarray, landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Model:
    """Model of a bounded sample of labelled texts.

    A toxic text is known to hold a toxic word, not which one: the machine learns from the word of largest
    margin in each toxic text, against all words of the others; the choice and the machine take turns, the first
    choice being the word nearest to a landmark. With one label only, every score is that label's share.
    """
    toxic = np.asarray(toxic, np.int64)
    n_toxic, n_clean = int(toxic.sum()), int((toxic == 0).sum())
    names, counts = _texts_with(texts, toxic) if n_toxic and n_clean else ([], np.zeros((0, 2), np.int64))
    place = {n: i for i, n in enumerate(names)}
    row, word = _words_held(texts, place) if names else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    bad = toxic[row] == 1
    kernel = Kernel(choose_landmarks(names, counts, n_clean, n_toxic, landmarks, (row[bad], word[bad])))
    share = float(np.clip(toxic.mean() if len(toxic) else 0.0, 0.01, 0.99))
    if not kernel.landmarks:
        return Model(kernel, np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    raw = kernel.values(names)
    near = np.flatnonzero(raw.any(1))  # few words are like any landmark; only these have features
    position, margin = np.full(len(names), -1), raw.max(1).astype(np.float64)
    position[near] = np.arange(len(near))
    raw = raw[near].astype(np.float64)
    # Nyström: the landmarks' kernel matrix to the power -1/2, small eigenvalues left out.
    own = kernel.values(kernel.landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    kept = values > 1e-3
    root = vectors[:, kept] / np.sqrt(values[kept])
    x = raw @ root
    clean = near[counts[near, 0] > 0]
    some = (position[word] >= 0) & (toxic[row] == 1)
    row_t, word_t = row[some], word[some]
    for _ in range(rounds):
        order = np.lexsort((margin[word_t], row_t))
        last = np.flatnonzero(np.append(row_t[order][1:] != row_t[order][:-1], True)) if len(order) else []
        found, times = np.unique(word_t[order][last], return_counts=True)
        if not len(found):
            break
        # Words of clean texts weigh by their texts; one row stands for all words unlike any landmark.
        rows_x = np.concatenate([x[position[found]], x[position[clean]], np.zeros((1, x.shape[1]))])
        y = np.concatenate([np.ones(len(found)), -np.ones(len(clean) + 1)])
        weight = np.concatenate([times / times.sum(), np.sqrt(np.append(counts[clean, 0], 1))])
        weight[len(found) :] /= weight[len(found) :].sum()
        w = _hinge(rows_x, y, weight / 2)
        margin = np.full(len(names), w[-1])
        margin[near] = x @ w[:-1] + w[-1]
    best = np.full(len(texts), w[-1])
    np.maximum.at(best, row, margin[word])
    # A logistic curve over the texts' margins, both labels weighing the same; a small penalty keeps it finite.
    balance = np.where(toxic == 1, 0.5 / n_toxic, 0.5 / n_clean)
    points, curve = np.column_stack([best, np.ones(len(best))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(points @ curve, -50, 50)))
        slope = points.T @ (balance * (toxic - p)) - PENALTY * curve
        bend = (points * (balance * p * (1 - p))[:, None]).T @ points + PENALTY * np.eye(2)
        curve = curve + np.clip(np.linalg.solve(bend, slope), -1, 1)
    return Model(kernel, root @ w[:-1], float(w[-1]), float(curve[0]), float(curve[1]))


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, text_column: str = "text", most: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """At most ``most`` labelled rows where ``learn`` holds, chosen by a hash: toxic ones up to half, others up to the rest."""
    rows = docs.filter(learn).select("doc_id", F.col(text_column).alias("text"))
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    picked = []
    for label in (1, 0):
        # The ids are drawn before any text moves.
        ids = known.filter(F.col("toxic") == label).join(rows.select("doc_id"), "doc_id", "left_semi").orderBy(order, "doc_id").limit(most // 2)
        picked.append(ids)
    drawn = F.broadcast(picked[0].union(picked[1]).dropDuplicates(["doc_id"]))  # at most ``most`` ids
    found = rows.join(drawn, "doc_id").select("doc_id", "text", "toxic").toPandas().sort_values(["doc_id", "text"])
    found = found.drop_duplicates("doc_id")
    return [t or "" for t in found["text"]], found["toxic"].to_numpy(np.int64)


def _score(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, start = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False), 0
            while start < batch.num_rows:
                fit = max(1, int(np.searchsorted(np.cumsum(sizes[start:]), TEXT_BYTES, side="right")))
                part = batch.slice(start, fit)
                start += fit
                columns = [part.column(i) for i in range(1, part.num_columns)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(model.scores(part.column(0)).astype(np.float64))], names=[*batch.schema.names[1:], "score"])

    return score


def score_texts(docs: DataFrame, model: Model, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and the score (0 to 1) of every whole text; null and empty texts score as without any word."""
    chosen = docs.select(F.col(text_column).alias("__text"), *(keep or ["doc_id"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[1:])
    return chosen.mapInArrow(_score(model), f"{schema}, score double")
