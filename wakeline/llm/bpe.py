"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

The merge list determines how far to the right a token can depend on bytes not read yet. A change at
the end of a text moves left only through merges of ever later rank: whether merge r takes place
decides whether the token at its start is free to be the right part of a later merge r', which then
decides the same one token further left. ``sufficient_lookahead`` follows those chains over the whole
list. The encoder takes a text in blocks. Of its buffer it emits what is stable whatever follows: special
tokens, then pre-tokens that end so far before the buffer's end that no pattern can reach them, and,
where one pre-token fills the buffer, its tokens that end at least the lookahead before the end. Memory is
constant: lookahead and block size bound the buffers, a bounded cache holds encoded words. Ids leave
block by block and go straight into the decoder, which turns them into text with an incremental
UTF-8 state machine.

The plan is one scan and one Arrow map: no shuffle.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .common import read_table, small_batches, text_of

#: The pre-tokenization pattern of the byte-level vocabulary (fixed value; \s spelled out as the Unicode property).
PATTERN = (
    r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
CACHE_WORDS = 400_000
#: Characters of text that a step of the transducer takes, and about the most that its buffer holds.
BLOCK = 4096
#: Characters after a pre-token that settle it: a contraction looks two ahead, a run and a blank one.
PATTERN_LOOKAHEAD = 4
SHORT_WORD = 40
DEFAULT_VOCABULARY = "byte_bpe_50k.json"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable bytes as themselves, others from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b != 0x20 and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes right of a token's end that settle it under ``merges``, in order of rank.

    reach[r] is how far left of the start of r's right part a decision on r can act: the length of r's
    left part, plus the largest reach of a later merge whose right part begins with r's left part, as
    only such a merge can take up or miss the token that starts there. That holds for lists in which
    every part of a merge is a byte or made by an earlier merge; others are refused.
    """
    made: set[bytes] = set()
    for left, right in merges:
        if any(len(x) > 1 and x not in made for x in (left, right)):
            raise ValueError(f"the merge of {left!r} and {right!r} stands before one that makes its parts")
        made.add(left + right)
    best: dict[bytes, int] = {}
    bound = 0
    for left, right in reversed(merges):
        reach = len(left) + best.get(left, 0)
        bound = max(bound, reach + len(right))
        for n in range(1, len(right) + 1):
            if best.get(right[:n], 0) < reach:
                best[right[:n]] = reach
    return bound


class Transducer:
    """Encoder and decoder of one byte-level BPE vocabulary."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if all(c in letters for c in t)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merges = [(as_bytes(a), as_bytes(b)) for a, b in pairs]
        self.rank = {m: i for i, m in reversed(list(enumerate(merges)))}
        self.lookahead = sufficient_lookahead(merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.by_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.bytes_of = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.runs = [regex.compile(f"{kind}+") for kind in (r"\p{White_Space}", r"\p{L}", r"\p{N}", r"[^\p{White_Space}\p{L}\p{N}]")]
        self.words = _Words(self)
        self.pieces = _Pieces(self)

    def merge(self, data: bytes) -> list[bytes]:
        """The tokens of ``data``: the adjacent pair of lowest rank, leftmost first, is joined until none is left."""
        n = len(data)
        parts = [data[i : i + 1] for i in range(n)]
        if n < 2:
            return parts
        if n <= SHORT_WORD:
            return self._merge_short(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        rank = self.rank
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if j < 0 or parts[i] is None or rank.get((parts[i], parts[j])) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            k = after[i] = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (r := rank.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return [p for p in parts if p is not None]

    def _merge_short(self, parts: list[bytes]) -> list[bytes]:
        """The same by looking for the least rank anew each time, which is faster for a few parts."""
        get, none = self.rank.get, len(self.rank)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:])]  # noqa: B905
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
        return parts

    def encode_word(self, word: str) -> bytes:
        """Ids of one pre-token as little-endian unsigned 32-bit integers."""
        run = _Run(self)
        return run.feed(word.encode("utf-8", "surrogatepass")) + run.end()

    def encode_plain(self, text: str) -> bytes:
        """Ids of whole pre-tokens without special tokens.

        A single blank between other characters always begins a pre-token, so texts are cut there and
        pieces looked up; texts with other blank runs are matched against the pattern.
        """
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            return b"".join([self.pieces.first(first), *map(self.pieces.__getitem__, rest)])
        except _Uncut:
            return b"".join(map(self.words.__getitem__, self.pattern.findall(text)))

    def stream(self, blocks: Iterable[str]) -> Iterator[bytes]:
        """Ids of a text that arrives in blocks, as soon as they are stable; strings of special tokens become their ids."""
        plain, buffer = _Plain(self), ""
        longest = max(map(len, self.special), default=1)
        for block in blocks:
            buffer += block
            while self.by_special and (m := self.by_special.search(buffer)) and m.start() + longest <= len(buffer):
                yield plain.feed(buffer[: m.start()]) + plain.end() + self.special[m[0]].to_bytes(4, "little")
                buffer = buffer[m.end() :]
            cut = len(buffer) - longest + 1
            if cut > 0:
                yield plain.feed(buffer[:cut])
                buffer = buffer[cut:]
        for i, part in enumerate(self.by_special.split(buffer) if self.by_special else [buffer]):
            yield self.special[part].to_bytes(4, "little") if i % 2 else plain.feed(part) + plain.end()

    def encode(self, text: str) -> bytes:
        """All ids of ``text``."""
        return b"".join(self.stream(blocks_of(text)))

    def decode(self, parts: Iterable[bytes]) -> Iterator[str]:
        """Text of ids that arrive in parts: a character leaves as soon as its last byte has come in."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        table = self.bytes_of
        for part in parts:
            yield machine.decode(b"".join([table[i] for i in memoryview(part).cast("I")]))
        yield machine.decode(b"", True)


def blocks_of(text: str, size: int = BLOCK) -> Iterator[str]:
    return (text[i : i + size] for i in range(0, len(text), size))


class _Run:
    """The tokens of one pre-token that arrives in parts, as ids."""

    def __init__(self, of: Transducer):
        self.of, self.buffer = of, b""

    def _ids(self, tokens: Iterable[bytes]) -> bytes:
        ids = self.of.ids
        return b"".join([ids[t].to_bytes(4, "little") for t in tokens])

    def feed(self, data: bytes) -> bytes:
        """Ids of the tokens that end at least the lookahead before the end of the buffer."""
        self.buffer += data
        settled = len(self.buffer) - self.of.lookahead
        if settled < BLOCK // 2:
            return b""
        tokens, end = [], 0
        for token in self.of.merge(self.buffer):
            if end + len(token) > settled:
                break
            end += len(token)
            tokens.append(token)
        self.buffer = self.buffer[end:]
        return self._ids(tokens)

    def end(self) -> bytes:
        tokens, self.buffer = self.of.merge(self.buffer), b""
        return self._ids(tokens)


class _Plain:
    """The ids of text without special tokens that arrives in parts."""

    def __init__(self, of: Transducer):
        self.of, self.buffer = of, ""
        self.run: _Run | None = None
        self.more = None  # what continues the pre-token in ``run``
        self.white = False  # it consists of blanks
        self.skip = 0  # a blank in front of it

    def feed(self, text: str) -> bytes:
        self.buffer += text
        if len(self.buffer) < BLOCK:
            return b""
        out = self._continue(False) if self.run else b""
        if self.run or len(self.buffer) < BLOCK:
            return out
        if cut := self._blank():
            head, self.buffer = self.buffer[:cut], self.buffer[cut:]
            return out + self.of.encode_plain(head)
        # No blank to cut at: pre-tokens that nothing can change, and a run that fills the rest.
        settled, end = len(self.buffer) - PATTERN_LOOKAHEAD, 0
        parts = [out]
        for m in self.of.pattern.finditer(self.buffer):
            if m.end() > settled:
                break
            parts.append(self.of.words[m[0]])
            end = m.end()
        self.buffer = self.buffer[end:]
        if len(self.buffer) >= BLOCK // 2:
            first = self.of.pattern.match(self.buffer)[0]
            self.run, self.more = _Run(self.of), next(r for r in self.of.runs if r.match(first[-1]))
            self.white = self.more is self.of.runs[0]
            self.skip = int(first[0] == " " and not self.white)
            parts.append(self._continue(False))
        return b"".join(parts)

    def _blank(self) -> int:
        """The last place before a single blank between two characters that are none, far enough from the end; 0 if there is none."""
        text, at = self.buffer, len(self.buffer) - PATTERN_LOOKAHEAD
        while (at := text.rfind(" ", 1, at)) > 0:
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                return at
        return 0

    def _continue(self, last: bool) -> bytes:
        """Hand the run what belongs to it for sure."""
        m = self.more.match(self.buffer, self.skip)
        end, self.skip = m.end() if m else self.skip, 0
        open_ = end == len(self.buffer)
        if open_ and not last:
            end = max(0, end - PATTERN_LOOKAHEAD)
        elif self.white and not open_:
            end -= 1  # the last blank before something else goes with that, or stands alone
        out = self.run.feed(self.buffer[:end].encode("utf-8", "surrogatepass"))
        self.buffer = self.buffer[end:]
        if not open_ or last:
            out += self.run.end()
            self.run = None
        return out

    def end(self) -> bytes:
        """What is left, as the text ends here."""
        out = self._continue(True) if self.run and self.buffer else self.run.end() if self.run else b""
        self.run = None
        rest, self.buffer = self.buffer, ""
        return out + self.of.encode_plain(rest)


class _Uncut(Exception):
    """The text can't be cut at its blanks."""


class _Words(dict):
    """Pre-token to ids; emptied when it reaches CACHE_WORDS."""

    def __init__(self, of: Transducer):
        super().__init__()
        self.of = of

    def __missing__(self, word: str) -> bytes:
        ids = self.of.encode_word(word)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


class _Pieces(_Words):
    """What stands between two single blanks, to the ids of the blank and it."""

    def first(self, piece: str) -> bytes:
        if not piece or piece[-1].isspace():
            raise _Uncut
        return b"".join(map(self.of.words.__getitem__, self.of.pattern.findall(piece)))

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Uncut
        words = self.of.words
        if piece.isalpha():  # one pre-token
            ids = words[" " + piece]
        elif piece[-1] in ".,!?;:" and piece[:-1].isalpha():  # two
            ids = words[" " + piece[:-1]] + words[piece[-1]]
        else:
            ids = b"".join(map(words.__getitem__, self.of.pattern.findall(" " + piece)))
        if len(piece) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_VOCABULARY)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and the decoded text of every row.

    Null texts are empty: no ids, empty decoded text. Rows are independent, so repeated and tied rows
    give equal values; texts of any length are taken in blocks; other columns are not read.
    """
    small_batches(docs.sparkSession)
    path = path or default_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = transducer(path)
        for pdf in batches:
            ids = [of.encode(t) for t in pdf["text"]]
            texts = ["".join(of.decode([x])) for x in ids]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": ids, "decoded": texts})

    return docs.select("doc_id", text_of().alias("text")).mapInPandas(run, "doc_id long, ids binary, decoded string")


def digests(of: Transducer, text: str) -> tuple[int, str, str]:
    """Tokens, digest of the ids and of the decoded text; neither is ever held as a whole."""
    n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()

    def parts() -> Iterator[bytes]:
        nonlocal n
        for part in of.stream(blocks_of(text)):
            n += len(part) // 4
            ids.update(part)
            yield part

    for some in of.decode(parts()):
        decoded.update(some.encode("utf-8"))
    return n, ids.hexdigest(), decoded.hexdigest()


def digest_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of every row; rows and texts as in ``encode_documents``."""
    small_batches(docs.sparkSession)
    path = path or default_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = transducer(path)
        for pdf in batches:
            out = [(i, *digests(of, t)) for i, t in zip(pdf["doc_id"], pdf["text"], strict=True)]
            yield pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text_of().alias("text")).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: counts and digests of the ids and of the text decoded from them."""
    return digest_documents(read_table(spark, sf_dir, "documents"))
