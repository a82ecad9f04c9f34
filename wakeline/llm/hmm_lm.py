"""LM scoring with a hidden Markov language model.

The model: a chain of latent states, each of which emits words. Baum-Welch sums expected counts over
all training texts, in Spark, and a scaled forward recursion gives the exact likelihood of a whole text.

Training has two phases. First words are tied to classes, the TOP most frequent ones to one each, all
others to SHAPES classes by length and ending: rounds of expectation settle what the states mean, until
the likelihood gains less than GAIN or ROUNDS is reached, and exchange a few thousand numbers. Then
every word of the training vocabulary is untied: expected counts of (word, state) are summed by word in a
shuffle, and each state gets an emission probability for every training word. A word that training
has not seen takes the share of words seen once, by shape.

Long texts are exact too: texts are cut into blocks whose transfer matrices are multiplied in
lockstep, so the recursion takes as many steps as a block has tokens, and the vectors at block borders
come from products of whole blocks.

Plan: one pass turns texts into chunks with a dictionary each. Only dictionary entries, at most one a
word and chunk, are shuffled to be counted and to bring counts and emissions back; texts never
are, and no vocabulary is broadcast. Words are told apart by 64-bit hashes from there on. What is
gathered grows with the vocabulary of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, held_out, read_table, small_batches, text_of, written

HELD_OUT_OF = 7
STATES, ROUNDS = 4, 4
#: Rounds end when the likelihood's logarithm gains less than this share.
GAIN = 0.0005
TOP, SHAPES = 2000, 64
CLASSES = TOP + SHAPES
#: A chunk ends when it has so many bytes of text or so many documents.
CHUNK_BYTES, CHUNK_DOCS = 8 << 20, 8000
BLOCK = 1024
SMOOTH = 0.01
#: A state's emissions count as if the corpus's own shares had been seen in it so many times.
PRIOR = 50.0
#: Parts of one in which expected counts of words are summed.
FIXED = 4096
END = b""  # no word is empty

CHUNKS = "chunk long, ids array<long>, held array<boolean>, sizes array<int>, codes binary, words array<long>, shapes array<tinyint>, counts array<long>"


def tokenize(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, then the end."""
    out = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out.append(END)
    return out


def shape(token: bytes) -> int:
    """The class among SHAPES of a token, by length and ending."""
    last = token[-1:]
    kind = 1 if last == b"." else 2 if last == b"," else 0 if token.isalpha() or max(token, default=0) > 127 else 3
    return min(max(len(token), 1), 16) * 4 - 4 + kind


def squeeze(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers in few bytes: all their first bytes, then all their second ones, and so on, deflated."""
    return zlib.compress(numbers.astype(kind).view(np.uint8).reshape(len(numbers), -1).T.tobytes(), 1)


def unsqueeze(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def word_hash(token: bytes) -> int:
    x = xxhash.xxh3_64_intdigest(token)
    return x - (1 << 64) if x >> 63 else x


class _Codes(dict):
    def __missing__(self, token: bytes) -> int:
        self[token] = n = len(self)
        return n


def _chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    task, seq = TaskContext.get().partitionId(), 0
    ids, held, sizes, parts, size, book = [], [], [], [], 0, _Codes()

    def done() -> pd.DataFrame:
        codes = np.concatenate(parts)
        order = np.argsort(-np.bincount(codes), kind="stable")  # frequent words get small codes
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        codes = rank[codes]
        trains = np.repeat(~np.asarray(held, bool), sizes)
        counts = np.bincount(codes[trains], minlength=len(book))
        words = list(book)
        words = [words[k] for k in order.tolist()]
        return pd.DataFrame(
            {
                "chunk": [(task << 32) + seq],
                "ids": [ids],
                "held": [held],
                "sizes": [sizes],
                "codes": [squeeze(codes, "<u4")],
                "words": [[word_hash(w) for w in words]],
                "shapes": [[shape(w) for w in words]],
                "counts": [counts.tolist()],
            }
        )

    for pdf in batches:
        for i, h, text in zip(pdf["doc_id"], pdf["held"], pdf["text"], strict=True):
            tokens = tokenize(text)
            parts.append(np.fromiter(map(book.__getitem__, tokens), np.int64, len(tokens)))
            ids.append(None if pd.isna(i) else int(i))
            held.append(bool(h))
            sizes.append(len(tokens))
            size += len(text)
            if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                yield done()
                seq += 1
                ids, held, sizes, parts, size, book = [], [], [], [], 0, _Codes()
    if ids:
        yield done()


@dataclass
class Lexicon:
    """What of the corpus's counts every task gets: bounded by CLASSES."""

    tokens: int  # N
    kinds: int  # V
    top: np.ndarray  # hashes of the most frequent words, sorted
    class_of: np.ndarray  # their classes
    class_tokens: np.ndarray
    once: np.ndarray  # words seen once, by shape

    def classes(self, words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """Class of every word, by its hash and shape."""
        out = TOP + shapes.astype(np.int64)
        if len(self.top):
            at = np.searchsorted(self.top, words).clip(max=len(self.top) - 1)
            hit = self.top[at] == words
            out[hit] = self.class_of[at[hit]]
        return out

    def unseen(self) -> np.ndarray:
        """Probability of a word that training has not seen, by shape: the share of words seen once."""
        share = min(0.5, (self.once.sum() + 1) / (self.tokens + 1))
        return share * (self.once + 1) / (self.once + 1).sum()


def build_lexicon(counts: DataFrame) -> Lexicon:
    """From (h, shape, c), c > 0."""
    best = counts.orderBy(F.desc("c"), "h").limit(TOP).collect()
    total, once = np.zeros(CLASSES), np.zeros(SHAPES)
    n = v = 0
    # At most SHAPES rows: a word of the most frequent ones is taken out of its shape below.
    for r in counts.groupBy("shape").agg(F.sum("c").alias("c"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("once")).collect():
        total[TOP + r["shape"]], once[r["shape"]] = r["c"], r["once"]
        n, v = n + r["c"], v + r["v"]
    for k, r in enumerate(best):
        total[k] = r["c"]
        total[TOP + r["shape"]] -= r["c"]
    top = np.array([r["h"] for r in best], np.int64)
    order = np.argsort(top)
    return Lexicon(int(n), int(v), top[order], order, total, once)


@dataclass
class Hmm:
    start: np.ndarray  # K
    step: np.ndarray  # K x K
    emit: np.ndarray  # CLASSES x K

    @staticmethod
    def initial(lexicon: Lexicon) -> Hmm:
        """Frequencies with a fixed random tilt a state, as equal states would stay equal; states tend to last."""
        rng = np.random.default_rng(11)
        tilt = np.exp(rng.normal(0, 0.5, (CLASSES, STATES)))
        emit = (lexicon.class_tokens[:, None] + SMOOTH) * tilt
        step = 0.9 * np.eye(STATES) + 0.1 / STATES
        return Hmm(np.full(STATES, 1 / STATES), step, emit / emit.sum(0))

    @staticmethod
    def from_counts(start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> Hmm:
        """From expected counts."""
        start, step, emit = start + SMOOTH, step + SMOOTH, emit + SMOOTH
        return Hmm(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


class Blocks:
    """The texts of a chunk as blocks of up to BLOCK tokens, longest first, walked in lockstep.

    The first token of a text belongs to no block: it starts the text's vector. codes index the rows of
    the emissions that the methods are given. Only texts of several blocks need transfer matrices.
    """

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        self.codes = codes
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        rest = sizes - 1
        self.per_text = -(-rest // BLOCK)
        text = np.repeat(np.arange(len(sizes)), self.per_text)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(self.per_text) - self.per_text, self.per_text)
        length = np.minimum(BLOCK, rest[text] - nth * BLOCK)
        order = np.argsort(-length, kind="stable")
        self.text, self.length = text[order], length[order]
        self.at = (self.first[text] + 1 + nth * BLOCK)[order]
        self.place = np.empty_like(order)  # of block (text, nth) in the order
        self.place[order] = np.arange(len(order))
        self.base = np.cumsum(self.per_text) - self.per_text
        self.chained = np.flatnonzero(self.per_text[self.text] > 1)
        self.slot = np.full(len(order), -1)
        self.slot[self.chained] = np.arange(len(self.chained))

    @staticmethod
    def _active(length: np.ndarray) -> list[int]:
        """How many blocks have a token t, for every t; the longest come first."""
        return [int(np.searchsorted(-length, -t, side="left")) for t in range(int(length.max(initial=0)))]

    def _transfer(self, hmm: Hmm) -> np.ndarray:
        """Scaled product of the matrices of each block of a text that has several."""
        n, k = len(self.chained), STATES
        m = np.broadcast_to(np.eye(k), (n, k, k)).copy()
        at = self.at[self.chained]
        for t, live in enumerate(self._active(self.length[self.chained])):
            x = (m[:live].reshape(-1, k) @ hmm.step).reshape(live, k, k) * hmm.emit[self.codes[at[:live] + t]][:, None, :]
            m[:live] = x / x.sum((1, 2))[:, None, None]
        return m

    def _before(self, hmm: Hmm, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vector before each block, and the log likelihood of each text's first token."""
        v = hmm.start * hmm.emit[self.codes[self.first]]
        s = v.sum(1)
        v /= s[:, None]
        into = np.empty((len(self.length), STATES))
        for j in range(int(self.per_text.max(initial=0))):
            who = np.flatnonzero(self.per_text > j)
            b = self.place[self.base[who] + j]
            into[b] = v[who]
            more = self.per_text[who] > j + 1
            x = np.einsum("nk,nkl->nl", v[who[more]], m[self.slot[b[more]]])
            v[who[more]] = x / x.sum(1, keepdims=True)
        return into, np.log(s)

    def _after(self, m: np.ndarray) -> np.ndarray:
        """The vector after each block."""
        v = np.ones((len(self.first), STATES))
        out = np.empty((len(self.length), STATES))
        for j in range(int(self.per_text.max(initial=0)) - 1, -1, -1):
            who = np.flatnonzero(self.per_text > j)
            b = self.place[self.base[who] + j]
            out[b] = v[who]
            if j:
                x = np.einsum("nkl,nl->nk", m[self.slot[b]], v[who])
                v[who] = x / x.sum(1, keepdims=True)
        return out

    def forward(self, hmm: Hmm, keep: list | None = None) -> np.ndarray:
        """Log likelihood of each text; ``keep`` gets the matrices and the vectors after every step."""
        m = self._transfer(hmm)
        v, like = self._before(hmm, m)
        if keep is not None:
            keep += [m, v.copy()]
        log = np.zeros(len(v))
        for t, live in enumerate(self._active(self.length)):
            x = (v[:live] @ hmm.step) * hmm.emit[self.codes[self.at[:live] + t]]
            s = x.sum(1)
            x /= s[:, None]
            v[:live] = x
            log[:live] += np.log(s)
            if keep is not None:
                keep.append(x)
        return like + np.bincount(self.text, log, len(like))

    def expected(self, hmm: Hmm) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Log likelihood and expected counts of starts, steps and emissions: the E step of Baum-Welch."""
        k = STATES
        kept: list = []
        like = self.forward(hmm, kept)
        m, *alphas = kept
        beta = self._after(m)
        steps = np.zeros((k, k))
        gamma = np.empty((len(self.codes), k), np.float32)  # of every token
        active = self._active(self.length)
        for t in range(len(active) - 1, -1, -1):
            live = active[t]
            here = self.at[:live] + t
            both = alphas[t + 1] * beta[:live]
            gamma[here] = both / both.sum(1, keepdims=True)
            w = hmm.emit[self.codes[here]] * beta[:live]
            before = alphas[t][:live]
            back = w @ hmm.step.T
            norm = (before * back).sum(1)
            steps += hmm.step * ((before / norm[:, None]).T @ w)
            beta[:live] = back / back.sum(1, keepdims=True)
        first = hmm.start * hmm.emit[self.codes[self.first]]
        has = np.flatnonzero(self.per_text)
        first[has] *= beta[self.place[self.base[has]]]
        first /= first.sum(1, keepdims=True)
        gamma[self.first] = first
        emit = np.stack([np.bincount(self.codes, gamma[:, s], len(hmm.emit)) for s in range(k)], 1)
        return float(like.sum()), first.sum(0), steps, emit


@dataclass
class Chunk:
    """A row of the chunks, unpacked."""

    codes: np.ndarray
    sizes: np.ndarray
    words: np.ndarray
    shapes: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(row: object) -> Chunk:
        return Chunk(unsqueeze(row.codes, "<u4").astype(np.int64), np.asarray(row.sizes, np.int64), np.asarray(row.words, np.int64), np.asarray(row.shapes, np.int64), np.asarray(row.counts, np.int64))

    def training(self, held: object) -> tuple[np.ndarray, np.ndarray]:
        """Codes and sizes of the texts to learn from."""
        learn = ~np.asarray(held, bool)
        return self.codes[np.repeat(learn, self.sizes)], self.sizes[learn]


def baum_welch(chunks: DataFrame, lexicon: Lexicon, hmm: Hmm, rounds: int = ROUNDS) -> Hmm:
    """Rounds of expectation over all training texts with words tied to classes; counts meet in a shuffle."""
    k, before = STATES, None
    for _ in range(rounds):

        def run(batches: Iterator[pd.DataFrame], hmm: Hmm = hmm) -> Iterator[pd.DataFrame]:
            total = np.zeros(1 + k * (1 + k + CLASSES))
            for pdf in batches:
                for r in pdf.itertuples(index=False):
                    chunk = Chunk.of(r)
                    codes, sizes = chunk.training(r.held)
                    if len(sizes):
                        z = lexicon.classes(chunk.words, chunk.shapes)
                        like, start, step, emit = Blocks(z[codes], sizes).expected(hmm)
                        total += np.concatenate([[like], start, step.ravel(), emit.ravel()])
            at = np.flatnonzero(total)
            yield pd.DataFrame({"at": at, "x": total[at]})

        total = np.zeros(1 + k * (1 + k + CLASSES))
        sums = chunks.drop("chunk", "ids").mapInPandas(run, "at long, x double")
        for r in sums.groupBy("at").agg(F.sum("x").alias("x")).collect():  # one row a parameter
            total[r.at] = r.x
        hmm = Hmm.from_counts(total[1 : 1 + k], total[1 + k : 1 + k + k * k].reshape(k, k), total[1 + k + k * k :].reshape(CLASSES, k))
        if before is not None and total[0] - before <= GAIN * abs(before):
            break
        before = total[0]
    return hmm


def word_counts(chunks: DataFrame, lexicon: Lexicon, hmm: Hmm) -> DataFrame:
    """(h, c, x0, ..): count of each training word over the corpus, and how often each state but the last emits it.

    The latter are expected numbers in FIXED-ths: whole numbers take little room, and their sums don't depend
    on their order. What is left of the word's count is the last state's.
    """
    names = [f"x{s}" for s in range(STATES - 1)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                chunk = Chunk.of(r)
                codes, sizes = chunk.training(r.held)
                if not len(sizes):
                    continue
                z = lexicon.classes(chunk.words, chunk.shapes)
                tied = Hmm(hmm.start, hmm.step, hmm.emit[z])  # a row a dictionary entry
                emit = Blocks(codes, sizes).expected(tied)[3]
                used = np.flatnonzero(chunk.counts)
                counts = {n: np.rint(emit[used, s] * FIXED).astype(np.int64) for s, n in enumerate(names)}
                yield pd.DataFrame({"h": chunk.words[used], "c": chunk.counts[used]} | counts)

    found = chunks.drop("chunk", "ids").mapInPandas(run, "h long, c long, " + ", ".join(f"{n} long" for n in names))
    return found.groupBy("h").agg(*(F.sum(n).alias(n) for n in ("c", *names)))


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Training texts are those whose crc32(doc_id) modulo HELD_OUT_OF is not 2. Null and empty texts are
    one token, the end. Repeated rows count as often as they occur. Without training texts N and V are
    0 and every word is an unseen one. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", held_out(HELD_OUT_OF).alias("held"), text_of().alias("text"))
    chunks = written(rows.mapInPandas(_chunked, CHUNKS), "chunks")
    entries = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts", "shapes")).alias("at", "e"))
    entries = entries.select("chunk", "at", F.col("e.words").alias("h"), F.col("e.counts").alias("n"), F.col("e.shapes").cast("int").alias("shape"))
    counts = written(entries.where("n > 0").groupBy("h").agg(F.sum("n").alias("c"), F.max("shape").alias("shape")), "counts")
    lexicon = build_lexicon(counts)
    hmm = baum_welch(chunks, lexicon, Hmm.initial(lexicon))
    names = [f"x{s}" for s in range(STATES - 1)]
    discard(counts)
    known = written(word_counts(chunks, lexicon, hmm), "emissions")
    sums = known.agg(*(F.coalesce(F.sum(n), F.lit(0)) for n in names)).first()
    mass = np.array([float(x) / FIXED for x in sums])
    mass = np.append(mass, max(0.0, lexicon.tokens - mass.sum())) + PRIOR
    unseen = lexicon.unseen()
    found = entries.select("chunk", "at", "h").join(known, "h", "left").select("chunk", "at", "c", *names)

    def run(key: tuple, payload: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        row = next(payload.itertuples(index=False))
        codes, sizes = unsqueeze(row.codes, "<u4").astype(np.int64), np.asarray(row.sizes, np.int64)
        entry = entry.sort_values("at")
        c = entry["c"].fillna(0).to_numpy(np.float64)
        base = np.log10((c + 1) / (lexicon.tokens + lexicon.kinds + 1))
        emit = entry[names].fillna(0).to_numpy(np.float64) / FIXED
        emit = np.column_stack([emit, np.maximum(0.0, c - emit.sum(1))])
        emit = (1 - unseen.sum()) * (emit + PRIOR * c[:, None] / max(1, lexicon.tokens)) / mass
        new = c == 0
        emit[new] = unseen[np.asarray(row.shapes, np.int64)[new]][:, None]
        model = Hmm(hmm.start, hmm.step, emit)
        blocks = Blocks(codes, sizes)
        like = blocks.forward(model)
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if pd.isna(i) else int(i) for i in row.ids], dtype="Int64"),
                "held_out": row.held,
                "n_tokens": sizes,
                "n_known": np.add.reduceat((c > 0).astype(np.int64)[codes], at),
                "train_tokens": lexicon.tokens,
                "base_score": np.add.reduceat(base[codes], at),
                "score": like / np.log(10),
            }
        )

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    payload = chunks.select(F.col("chunk").alias("part"), "ids", "held", "sizes", "codes", "shapes")
    return payload.groupBy("part").cogroup(found.groupBy("chunk")).applyInPandas(run, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: base and model scores of every document."""
    return score_texts(read_table(spark, sf_dir, "documents"))
