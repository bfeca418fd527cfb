"""Language identification by unigram pieces, summed over all segmentations of a word.

The pieces are those of a fixed public vocabulary of byte strings, which holds every single byte.
Each language has a probability for each piece; a word's probability is the sum over all ways to
cut it into pieces, by the forward algorithm. Probabilities come from expectation maximisation:
words of all training texts are counted once by language, and each step adds up, over the distinct
words, how often every piece is expected in them.

A word is a space and a run of letters, lower-cased; runs are cut every LONGEST letters, so that no
word is unbounded and no letter is left out. What is no letter tells nothing about the language.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisketch.session import materialize

LONGEST = 20
RUNS = regex.compile(r"\p{L}[\p{L}\p{M}]{0,%d}" % (LONGEST - 1))
SEPARATORS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
STEPS = 2
FLOOR = 0.01
"""The part of each language's probability that all pieces share alike."""
PER_BYTE = 1e3
PACKED = 8
"""Bytes that an integer holds; so long pieces are found for many words at once."""
MOST_LANGUAGES = 500
"""Bounds the broadcast model: so many floats for each of the pieces."""
UNDETERMINED = "und"
CACHED_TOKENS = 300_000
CACHED_BYTES = 1 << 26
COUNTED_BYTES = 1 << 25
WORDS_AT_ONCE = 8192
WORDS_A_TASK = 50_000


def read_pieces(file: str) -> list[bytes]:
    """The byte strings of a vocabulary file with a line of base64 and a rank for each piece."""
    with open(file, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def letter_pieces(pieces: list[bytes]) -> list[bytes]:
    """Those that can occur in a word: letters after at most one space; and all single bytes."""
    return [p for p in pieces if len(p) == 1 or p[:1] + p[1:].translate(SEPARATORS).replace(b" ", b"") == p and (p[0] == 32 or SEPARATORS[p[0]] != 32)]


def words_of(token: bytes) -> list[bytes]:
    """The words of a lower-cased run of bytes that are ASCII letters or beyond ASCII."""
    if token.isascii() and len(token) <= LONGEST:
        return [b" " + token]
    return [b" " + run.encode() for run in RUNS.findall(token.decode())]


def tokens_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(SEPARATORS).split()


@dataclass
class Model:
    """Probabilities of the pieces (rows) in the languages (columns), and log shares of the languages."""

    pieces: list[bytes]
    languages: list[str]
    shares: np.ndarray
    priors: np.ndarray
    name: str = field(init=False)

    def __post_init__(self) -> None:
        seen = hashlib.sha256(self.shares.tobytes() + self.priors.tobytes() + repr(self.languages).encode())
        self.name = seen.hexdigest()


def _find(known: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Where the codes stand among the known, sorted ones; -1 for those that do not."""
    if not len(known):
        return np.full(len(codes), -1)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[at] == codes, at, -1)


class Pieces:
    """Places of byte strings in the vocabulary, for whole columns of bytes at once."""

    def __init__(self, pieces: list[bytes]):
        self.index = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.packed = []
        for size in range(1, PACKED + 1):
            same = sorted((int.from_bytes(p, "big"), i) for p, i in self.index.items() if len(p) == size)
            self.packed.append((np.array([c for c, _ in same], np.uint64), np.array([i for _, i in same], np.int64)))
        self.beginnings = np.unique(np.array([int.from_bytes(p[:PACKED], "big") for p in pieces if len(p) > PACKED], np.uint64))

    def of(self, size: int, codes: np.ndarray) -> np.ndarray:
        """Places of the pieces of `size` bytes, at most PACKED, that the integers spell; -1 for none."""
        known, places = self.packed[size - 1]
        at = _find(known, codes)
        return np.where(at >= 0, places[at], -1) if len(known) else at


class Lattice:
    """All pieces in words of one length: piece[(i, j)][w] is the piece of word w from i to j, or -1."""

    def __init__(self, pieces: Pieces, words: list[bytes]):
        n, self.words = len(words[0]), words
        letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), n).astype(np.uint64)
        self.piece: dict[tuple[int, int], np.ndarray] = {}
        for i in range(n):
            codes = np.zeros(len(words), np.uint64)
            for j in range(i + 1, min(n, i + PACKED) + 1):
                codes = (codes << np.uint64(8)) | letters[:, j - 1]
                self._add(i, j, pieces.of(j - i, codes))
            if i + PACKED < n:
                begun = np.flatnonzero(_find(pieces.beginnings, codes) >= 0).tolist()
                for j in range(i + PACKED + 1, min(n, i + pieces.longest) + 1) if begun else ():
                    ids = np.full(len(words), -1)
                    ids[begun] = [pieces.index.get(words[w][i:j], -1) for w in begun]
                    self._add(i, j, ids)

    def _add(self, i: int, j: int, ids: np.ndarray) -> None:
        if (ids >= 0).any():
            self.piece[i, j] = ids

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """sums[j]: for all words and languages, the sum over the segmentations of the first j bytes.

        `weights` has zeros as its last row, which is where -1 leads.
        """
        sums = np.zeros((len(self.words[0]) + 1, len(self.words), weights.shape[1]))
        sums[0] = 1
        for (i, j), ids in self.piece.items():
            sums[j] += sums[i] * weights[ids]
        return sums

    def backward(self, weights: np.ndarray) -> np.ndarray:
        """The same for the bytes from j on."""
        sums = np.zeros((len(self.words[0]) + 1, len(self.words), weights.shape[1]))
        sums[-1] = 1
        for (i, j), ids in reversed(self.piece.items()):
            sums[i] += sums[j] * weights[ids]
        return sums

    def expected(self, weights: np.ndarray, counts: np.ndarray, out: np.ndarray) -> None:
        """Adds to out[piece, language] the expected uses of pieces in words that occur counts[w, language] times."""
        ahead, behind = self.forward(weights), self.backward(weights)
        share = counts / ahead[-1]
        for (i, j), ids in self.piece.items():
            uses = ahead[i] * weights[ids] * behind[j] * share
            known = ids >= 0
            np.add.at(out, ids[known], uses[known])


class Segmenter:
    def __init__(self, pieces: list[bytes]):
        self.pieces = Pieces(pieces)

    def lattices(self, words: list[bytes]) -> Iterator[tuple[list[int], Lattice]]:
        """The words' places and their lattice, in blocks of words of one length."""
        places = sorted(range(len(words)), key=lambda k: len(words[k]))
        for size, same in itertools.groupby(places, key=lambda k: len(words[k])):
            same = list(same)
            step = max(1, WORDS_AT_ONCE * 8 // size)
            for begin in range(0, len(same), step):
                block = same[begin : begin + step]
                yield block, Lattice(self.pieces, [words[k] for k in block])

    def logs_of(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Log probabilities of the words in all languages."""
        out = np.zeros((len(words), weights.shape[1]))
        for places, lattice in self.lattices(words):
            out[places] = np.log(lattice.forward(weights)[-1]) - len(lattice.words[0]) * np.log(PER_BYTE)
        return out


def weights_of(model: Model) -> np.ndarray:
    """Probabilities times PER_BYTE for each byte of the piece, and a row of zeros.

    No probability is below FLOOR / pieces, so sums over a word's at most 81 bytes stay normal numbers.
    """
    sizes = np.array([len(p) for p in model.pieces], float)
    weights = model.shares.astype(float) * PER_BYTE ** sizes[:, None]
    return np.vstack([weights, np.zeros((1, weights.shape[1]))])


# ---- training --------------------------------------------------------------


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of (lang, text), summed over COUNTED_BYTES of text at a time."""
    counts: dict[str, Counter[bytes]] = defaultdict(Counter)

    def flushed() -> pa.RecordBatch:
        rows = []
        for lang, tokens in counts.items():
            words: Counter[bytes] = Counter()
            for token, n in tokens.items():
                for word in words_of(token):
                    words[word] += n
            rows += [(lang, word, n) for word, n in words.items()]
        counts.clear()
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        kinds = (pa.string(), pa.binary(), pa.int64())
        return pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["lang", "word", "n"])

    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts[lang].update(tokens_of(text.as_py()))
            size += len(text.as_buffer())
            if size > COUNTED_BYTES:
                yield flushed()
                size = 0
    yield flushed()


def word_counts(training: DataFrame) -> DataFrame:
    """(lang, word, n) of the distinct words of (lang, text); rows with a null are left out."""
    rows = training.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.mapInArrow(_counted_words, "lang string, word binary, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expecting(shared: Broadcast[Model]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task (piece, language, uses) over the words of rows (lang, word, n)."""

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        segmenter, weights, out = Segmenter(model.pieces), weights_of(model), np.zeros(model.shares.shape)
        place = {lang: k for k, lang in enumerate(model.languages)}
        for batch in batches:
            langs = np.array([place[x] for x in batch.column(0).to_pylist()], int)
            words, times = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for places, lattice in segmenter.lattices(words):
                counts = np.zeros((len(places), len(place)))
                counts[np.arange(len(places)), langs[places]] = times[places]
                lattice.expected(weights, counts, out)
        piece, lang = np.nonzero(out)
        yield pa.record_batch([pa.array(piece), pa.array(lang), pa.array(out[piece, lang])], ["piece", "lang", "uses"])

    return expected


def learn(training: DataFrame, pieces: list[bytes], steps: int = STEPS) -> Model:
    """The model of (lang, text): every distinct word of all texts counts as often as it occurs.

    The first step starts from equal probabilities. A step gathers at most a number for each piece
    and language, which is the size of the model. Without any language the model knows none; more
    than MOST_LANGUAGES raise an error.
    """
    pieces = letter_pieces(pieces)
    known = training.where("lang IS NOT NULL AND text IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n"))
    shares = {r["lang"]: r["n"] for r in known.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()}
    if len(shares) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    sizes = np.array(list(shares.values()), float)
    same = np.full((len(pieces), len(shares)), 1 / max(1, len(pieces)))
    model = Model(pieces, list(shares), same, np.log(sizes / sizes.sum()) if shares else sizes)
    if not shares:
        return model
    words = materialize(word_counts(training), "words")
    words = words.repartition(max(1, words.count() // WORDS_A_TASK))
    for _ in range(steps):
        shared = training.sparkSession.sparkContext.broadcast(model)
        sent = words.mapInArrow(_expecting(shared), "piece long, lang long, uses double")
        uses = np.full(same.shape, 1e-9)
        summed = sent.groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toArrow()
        uses[summed["piece"].to_numpy(), summed["lang"].to_numpy()] += summed["uses"].to_numpy()
        model = Model(pieces, list(shares), (1 - FLOOR) * uses / uses.sum(axis=0) + FLOOR * same, model.priors)
    return model


# ---- prediction ------------------------------------------------------------


class Scorer:
    """Log probabilities of whole texts; those of short tokens are kept from text to text."""

    def __init__(self, model: Model):
        self.model, self.segmenter, self.weights = model, Segmenter(model.pieces), weights_of(model)
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.size = 0
        self.table = np.zeros((0, len(self.model.languages)))
        self.letters = np.zeros(0, bool)

    def _learn(self, tokens: list[bytes]) -> None:
        words = [words_of(t) for t in tokens]
        self.size += sum(map(len, tokens))
        flat = self.segmenter.logs_of(list(itertools.chain.from_iterable(words)), self.weights)
        sizes = np.array([len(w) for w in words], int)
        sums = np.zeros((len(tokens), flat.shape[1]))
        np.add.at(sums, np.repeat(np.arange(len(tokens)), sizes), flat)
        self.place |= {t: len(self.place) + k for k, t in enumerate(tokens)}
        self.table, self.letters = np.vstack([self.table, sums]), np.append(self.letters, sizes > 0)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """For a run of texts, the likeliest language and its probability given that it is a known one."""
        counted = [Counter(tokens_of(t)) if t else Counter() for t in texts]
        if len(self.place) > CACHED_TOKENS or self.size > CACHED_BYTES:
            self.forget()
        seen = set(itertools.chain.from_iterable(counted))
        self._learn([t for t in seen if t not in self.place])
        languages, scores = [], []
        for tokens in counted:
            at = np.fromiter(map(self.place.__getitem__, tokens), int, len(tokens))
            if not self.model.languages or not self.letters[at].any():
                languages.append(UNDETERMINED)
                scores.append(0.0)
                continue
            total = self.model.priors + np.array(list(tokens.values()), float) @ self.table[at]
            best = int(total.argmax())
            languages.append(self.model.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return languages, scores


_SCORERS: dict[str, Scorer] = {}
BYTES_AT_ONCE = 1 << 22


def scorer_of(model: Model) -> Scorer:
    """The scorer of this worker process; it outlives the task, and its tokens with it."""
    if model.name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.name] = Scorer(model)
    return _SCORERS[model.name]


def identify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with lang_pred and score (0 to 1) of each whole text.

    A text that is null or has no letter is `und` with score 0, as is every text where the model
    knows no language. Ties go to the first language in code point order. Repeated rows get equal
    results; other columns pass through (those of the two names are replaced). No shuffle.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = scorer_of(shared.value)
        for array in arrays:
            languages, scores = [], []
            ends = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in array])
            cuts = np.unique(np.append(np.flatnonzero(np.diff(ends // BYTES_AT_ONCE)) + 1, [0, len(array)]))
            for begin, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                some = score(array[begin:stop].to_pylist())
                languages += some[0]
                scores += some[1]
            columns = pa.array(languages, pa.string()), pa.array(scores, pa.float64())
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score"])

    # `predicted` is read twice but must run once, so the two fields come out of one generated row.
    kept = [F.col(c) for c in documents.columns if c not in ("lang_pred", "score")]
    return documents.select(*kept, F.inline(F.array(predicted(text))))


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, mod 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
