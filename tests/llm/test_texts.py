from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm import bpe, hmm_lm, media_columns, packing, secret_scan, url_filter, webp

from .conftest import SCHEMA, by_id, edge_rows, prose

# --- secrets ---------------------------------------------------------------------------------------


def brute_base(text):
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_bearer_tokens_in_mixed_case():
    for word in ("bearer", "Bearer", "BEARER", "BEarer", "bearER", "BeArEr"):
        t = f"é {word}  abcdefghij0123456789-."
        assert secret_scan.find_secrets(t) == [(2, 5, len(t))]


@pytest.mark.parametrize(("user", "password"), [(1, 3), (64, 128), (65, 3), (1, 129), (500, 4000)])
def test_url_logins_of_any_length(user, password):
    t = "see https://" + "u" * user + ":" + "p:" * (password // 2) + "p" * (password % 2) + "@host.example/x"
    assert secret_scan.find_secrets(t) == [(4, 6, t.index("@") + 1)]


SECRETS = ["password = hunter22", "TOKEN:'abcdef99'", "ſecret=abcdefgh", "Api_Key=\"x\"", "AKIA" + "B2" * 9, "xAKIAZ", "0123456789abcdef" * 2, "tokentoken = abc123456", "😀é"]


def test_base_spans_match_plain_patterns():
    r = random.Random(1)
    for _ in range(500):
        t = r.choice(["", " ", "\n"]).join(r.choice(SECRETS) for _ in range(r.randint(0, 6)))
        assert [s for s in secret_scan.find_secrets(t) if s[1] < 3] == brute_base(t)


def test_ledger_scans_only_unseen_blobs(spark, edge_docs, clashing_docs, empty_docs, tmp_path):
    rows = [(i, f"{prose(i, 5)} {SECRETS[i % len(SECRETS)]}", "en", "a", 0) for i in range(20)]
    docs = spark.createDataFrame(rows + rows[:3], SCHEMA)
    ledger = str(tmp_path / "ledger")
    found = secret_scan.scan_secrets(docs, ledger)
    assert found.count() == 23
    assert spark.read.parquet(ledger).count() == 20
    assert secret_scan.scan_secrets(docs.unionByName(spark.createDataFrame([(99, "new text", "en", "a", 0)], SCHEMA)), ledger).count() == 24
    assert spark.read.parquet(ledger).count() == 21
    for d in (edge_docs, clashing_docs):
        assert len(secret_scan.scan_secrets(d).collect()) == len(edge_rows())
    assert secret_scan.scan_secrets(empty_docs).count() == 0


def test_ledger_rows_of_two_writers_count_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "password = hunter22", "en", "s", 0), (2, "nothing", "en", "s", 0)], SCHEMA)
    ledger = f"{tmp_path}/ledger"
    secret_scan.update_ledger(docs, ledger)
    spark.read.parquet(ledger).write.mode("append").parquet(ledger + "2")
    spark.read.parquet(ledger).write.mode("append").parquet(ledger + "2")
    assert sorted(r.doc_id for r in secret_scan.scan_secrets(docs, ledger + "2").collect()) == [1, 2]
    assert secret_scan.redact_secrets(docs, ledger + "2").count() == 2


def test_changed_rules_scan_again(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "password = hunter22", "en", "s", 0)], SCHEMA)
    ledger = f"{tmp_path}/ledger"
    secret_scan.update_ledger(docs, ledger)
    secret_scan.update_ledger(docs, ledger)
    assert spark.read.parquet(ledger).count() == 1
    monkeypatch.setattr(secret_scan, "RULES_VERSION", "other")
    assert secret_scan.findings(spark, ledger).count() == 0
    secret_scan.update_ledger(docs, ledger)
    assert spark.read.parquet(ledger).count() == 2


def test_redaction_replaces_spans(spark, clashing_docs, empty_docs):
    text = "a password = hunter22 b AKIA" + "C" * 16 + " token=" + "ab" * 16
    out = secret_scan.redact_secrets(spark.createDataFrame([(1, text, "en", "s", 0), (2, None, None, None, None)], SCHEMA)).collect()
    of = {r.doc_id: r for r in out}
    assert of[1].text == "a [assign] b [access] [assign]" and of[1].n_chars == len(of[1].text)
    assert of[2].text is None
    assert secret_scan.redact_secrets(clashing_docs).count() == len(edge_rows())
    assert secret_scan.redact_secrets(empty_docs).count() == 0


# --- BPE -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.default_path())


def agree(tokenizer, text, block=None):
    of = bpe.transducer(bpe.default_path())
    ids = of.encode(text) if block is None else b"".join(of.stream(bpe.blocks_of(text, block)))
    as_list = np.frombuffer(ids, "<u4").tolist()
    assert as_list == tokenizer.encode(text, add_special_tokens=False).ids
    assert "".join(of.decode([ids])) == tokenizer.decode(as_list, skip_special_tokens=False)
    cut = 4 * (len(as_list) // 2)
    assert "".join(of.decode([ids[:cut], ids[cut:]])) == "".join(of.decode([ids]))


@pytest.mark.parametrize("text", ["", " ", "a", "  a  b ", "x\n y", "\x85a\x1cb", "<|endoftext|>a <|endoftext|>", "é" * 6000, "=" * 20000, "the" * 5000, "don't I'LL", "日本語 😀 ½²"])
def test_bpe_edges(tokenizer, text):
    agree(tokenizer, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abe 'st\n\té日😀.,\x1c\xa0<|endoftx>"), max_size=60) | st.text())
def test_bpe_matches_the_library(tokenizer, text):
    agree(tokenizer, text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["th", "er ", "ion", " ab", "=", "__", "  ", "\n", "1", "23 ", "'re", "'s", "<|endoftext|>", "<|endo", "日", "\xa0", "s", "'"]), max_size=120), st.integers(1, 9), st.sampled_from([8, 12, 40]))
def test_small_blocks_give_the_same_ids(tokenizer, parts, step, size):
    """Blocks and buffers of a few characters: all ways to cut a text are taken."""
    before, bpe.BLOCK = bpe.BLOCK, size
    try:
        agree(tokenizer, "".join(parts), step)
    finally:
        bpe.BLOCK = before


@pytest.mark.parametrize("unit", ["ab", "=", "_", "é", "7", "  ", "\n", " x", "the", "a1"])
def test_buffers_stay_bounded(tokenizer, unit):
    """However long a text or a pre-token is, no buffer holds more than a few blocks and the lookahead."""
    of = bpe.transducer(bpe.default_path())
    text, most = unit * (60_000 // len(unit)), 0
    merge, of.merge = of.merge, lambda data: note(len(data)) or merge(data)

    def note(n):
        nonlocal most
        most = max(most, n)

    try:
        agree(tokenizer, text)
    finally:
        del of.merge
    assert most <= 4 * bpe.BLOCK + of.lookahead


def test_improper_merge_lists_are_refused():
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([(b"ab", b"c"), (b"a", b"b")])


def test_documents_are_encoded(edge_docs, clashing_docs, empty_docs, tokenizer):
    want = sorted(((i, t or "") for i, t, *_ in edge_rows()), key=repr)
    for d in (edge_docs, clashing_docs):
        assert by_id(bpe.encode_documents(d), "decoded") == want
    assert bpe.encode_documents(empty_docs).count() == 0


# --- media -----------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=3000))
def test_stored_payload_round_trip(text):
    payload, n = media_columns.payload_of(text)
    assert len(payload) % 576 == 0 and payload[:n] == text.encode() and set(payload[n:]) <= {255}
    assert media_columns.pixels(media_columns.store(payload)).tobytes() == payload


def test_texts_of_several_images(spark):
    """Payloads over the format's most rows take several files, one after the other."""
    text = prose(5, 300) * 500 + "é" * 100
    payload, _ = media_columns.payload_of(text)
    assert len(payload) > 48 * media_columns.MAX_ROWS
    stored = media_columns.store(payload)
    assert stored.count(b"WEBPVP8L") == 2 and media_columns.pixels(stored).tobytes() == payload


def test_stored_forms_use_the_format(monkeypatch):
    """On texts of several kinds the writer takes references, the cache and transforms, so the reader meets them all."""
    seen = Counter()
    quick, copies = webp._read_literals, webp._copies

    def read_literals(bits, group, n):
        out = quick(bits, group, n)
        seen["general"] += out is None
        return out

    def found_copies(argb):
        out = copies(argb)
        seen["references"] += bool(out)
        return out

    def code(bits, size, read=webp.read_code):
        seen["cache"] += size > 256 + webp.LENGTH_CODES
        return read(bits, size)

    monkeypatch.setattr(webp, "read_code", code)
    monkeypatch.setattr(webp, "_read_literals", read_literals)
    monkeypatch.setattr(webp, "_copies", found_copies)
    texts = [prose(1, 400), "ab" * 3000, prose(2, 40) * 30, "".join(chr(97 + i % 7) for i in range(4000)), "x", "abcd" * 999, "the line\n" * 400]
    r = random.Random(3)
    words = ["".join(r.choice("etaoinshrdlucmfwypvbgkqjxz") for _ in range(r.randint(2, 9))) for _ in range(300)]
    texts.append(" ".join(r.choice(words) for _ in range(1500)))
    for t in texts:
        payload = media_columns.payload_of(t)[0]
        data = media_columns.store(payload)
        bits = webp.Bits(data[20:], 40)  # after signature, sizes, alpha and version
        seen["transform"] += bits.read(1)
        assert media_columns.pixels(data).tobytes() == payload
    assert seen["general"] >= 5 and seen["references"] and seen["transform"] and seen["cache"]


def test_media_edges(edge_docs, clashing_docs, empty_docs):
    for d in (edge_docs, clashing_docs):
        rows = media_columns.describe(media_columns.media_column(d)).collect()
        assert len(rows) == len(edge_rows())
        of = {r.doc_id: r for r in rows}
        payload = media_columns.payload_of(edge_rows()[3][1])[0]
        assert of[4].payload_sha256 == hashlib.sha256(payload).hexdigest() and of[4].tail_crc32 == zlib.crc32(payload[-32:])
        assert of[1].payload_bytes == 576 and of[5][1:] == of[6][1:]
    assert media_columns.media_column(empty_docs).count() == 0


@pytest.mark.parametrize("kind", ["prose", "few", "repeats", "steps", "grey", "noise"])
def test_stored_form_uses_the_format(kind, monkeypatch):
    """References, cache and transforms are written where they fit, and decoded by the general path."""
    r = np.random.default_rng(3)
    samples = {
        "prose": np.frombuffer(media_columns.payload_of(prose(4, 3000))[0], np.uint8).reshape(-1, 12, 4),
        "few": r.integers(0, 256, (3, 4)).astype(np.uint8)[r.integers(0, 3, (60, 12))],
        "repeats": np.tile(r.integers(0, 256, (7, 12, 4)).astype(np.uint8), (30, 1, 1)),
        "steps": np.cumsum(r.integers(0, 2, (600, 12, 4)), 1).astype(np.uint8) + r.integers(0, 256, (600, 1, 4)).astype(np.uint8),
        "grey": np.repeat(r.integers(0, 256, (600, 12, 1)), 4, 2).astype(np.uint8),
        "noise": r.integers(0, 256, (24, 12, 4)).astype(np.uint8),
    }[kind]
    quick, used = [], []
    plain = webp._read_literals
    monkeypatch.setattr(webp, "_read_literals", lambda *a: (x := plain(*a), quick.append(x is not None))[0])
    for name in ("_undo_predictor", "_undo_cross_colour", "_undo_subtract_green", "_undo_palette"):
        monkeypatch.setattr(webp, name, lambda *a, f=getattr(webp, name), name=name: (used.append(name), f(*a))[1])
    got, _ = webp.decode(webp.encode(samples))
    assert np.array_equal(got, samples)
    assert any(quick) == (kind == "noise")
    assert used == {"few": ["_undo_palette"], "steps": ["_undo_predictor"]}.get(kind, used) and (used or kind not in ("few", "steps", "grey"))
    assert len(webp.encode(samples)) <= len(webp._encode_fixed(samples)) + 21


def canonical(lengths):
    """Codes as (value in stream order, bits)."""
    used = sorted((n, s) for s, n in enumerate(lengths) if n)
    out, code, before = {}, 0, used[0][0]
    for n, s in used:
        code <<= n - before
        before = n
        out[s] = (int(f"{code:0{n}b}"[::-1], 2), n)
        code += 1
    return {used[0][1]: (0, 0)} if len(used) == 1 else out


class Encoder:
    """A writer of every feature of the format, for tests only."""

    def __init__(self, seed):
        self.out, self.r = webp.Writer(), random.Random(seed)

    def number(self, value):
        """Prefix, extra bits and their count of a length or distance."""
        v = value - 1
        if v < 4:
            return v, 0, 0
        k = v.bit_length() - 1
        return 2 * k + (v >> (k - 1) & 1), v & ((1 << (k - 1)) - 1), k - 1

    def code(self, used, size):
        """A prefix code for ``used`` symbols with ragged lengths, and what it writes."""
        used = sorted(used)
        if len(used) <= 2 and max(used, default=0) < 256 and self.r.random() < 0.7:
            self.out.put(1, 1)
            self.out.put(len(used) - 1 if used else 0, 1)
            wide = (used[0] if used else 0) > 1
            self.out.put(int(wide), 1)
            self.out.put(used[0] if used else 0, 8 if wide else 1)
            if len(used) == 2:
                self.out.put(used[1], 8)
            lengths = [0] * size
            for s in used or [0]:
                lengths[s] = 1
            return canonical(lengths)
        order = used[:]
        self.r.shuffle(order)
        lengths = [0] * size
        depth = [0]
        while len(depth) < len(order):
            depth.sort()
            k = self.r.randrange(len(depth)) if depth[0] > 6 or self.r.random() < 0.4 else 0
            k = k if depth[k] < 15 else 0
            d = depth.pop(k)
            depth += [d + 1, d + 1]
        for s, d in zip(order, depth):  # noqa: B905
            lengths[s] = max(d, 1)
        self.out.put(0, 1)
        runs, i = [], 0
        while i < size:
            j = i
            while j < size and lengths[j] == lengths[i]:
                j += 1
            n = j - i
            if lengths[i] == 0 and n >= 11:
                n = min(n, 138)
                runs.append((18, n - 11, 7))
            elif lengths[i] == 0 and n >= 3:
                n = min(n, 10)
                runs.append((17, n - 3, 3))
            elif lengths[i] and n >= 4:
                runs.append((lengths[i], 0, 0))
                n = min(n - 1, 6)
                runs.append((16, n - 3, 2))
                n += 1
            else:
                n = 1
                runs.append((lengths[i], 0, 0))
            i += n
        kinds = sorted({k for k, _, _ in runs})
        bits = max(1, (len(kinds) - 1).bit_length())
        of = [0] * 19
        full = 1 << bits
        for n, k in enumerate(kinds):
            of[k] = bits - 1 if bits > 1 and n < full - len(kinds) else bits
        if len(kinds) == 1:
            of[kinds[0]] = 1
        count = max(4, max(webp.LENGTH_ORDER.index(k) for k in kinds) + 1)
        self.out.put(count - 4, 4)
        for k in webp.LENGTH_ORDER[:count]:
            self.out.put(of[k], 3)
        if self.r.random() < 0.5:
            self.out.put(0, 1)
        else:
            self.out.put(1, 1)
            self.out.put(4, 3)
            self.out.put(len(runs) - 2, 10)
        codes = canonical(of)
        for k, extra, n in runs:
            self.out.put(*codes[k])
            self.out.put(extra, n)
        return canonical(lengths)

    def image(self, argb, width, top=False, cache_bits=0, groups=False):
        """Pixels with literals, back-references and cache hits wherever they fit."""
        self.out.put(int(cache_bits > 0), 1)
        if cache_bits:
            self.out.put(cache_bits, 4)
        height = len(argb) // width
        of, n_groups, shift = [0] * len(argb), 1, 2
        if top:
            self.out.put(int(groups), 1)
            if groups:
                self.out.put(shift - 2, 3)
                columns, rows, n_groups = -(-width // 4), -(-height // 4), 3
                meta = [self.r.randrange(n_groups) for _ in range(columns * rows)]
                meta[0] = n_groups - 1
                self.image([g << 8 for g in meta], columns)
                of = [meta[(i // width >> shift) * columns + (i % width >> shift)] for i in range(len(argb))]
        cache = [0] * (1 << cache_bits)
        ops, i, seen = [], 0, 0
        while i < len(argb):
            best = (0, 0)
            for d in range(1, min(i, 40) + 1):
                n = 0
                while i + n < len(argb) and argb[i + n] == argb[i + n - d] and n < 60:
                    n += 1
                best = max(best, (n, d))
            while seen < i:
                cache[webp.CACHE_FACTOR * argb[seen] % 2**32 >> (32 - cache_bits) if cache_bits else 0] = argb[seen]
                seen += 1
            slot = webp.CACHE_FACTOR * argb[i] % 2**32 >> (32 - cache_bits) if cache_bits else 0
            if best[0] >= 3:
                n, d = best
                near = [k for k, (x, y) in enumerate(webp.NEIGHBOURS) if max(1, x + y * width) == d]
                ops.append((i, "copy", n, self.r.choice(near) + 1 if near and self.r.random() < 0.7 else d + 120))
                i += n
            else:
                hit = cache_bits and cache[slot] == argb[i]
                ops.append((i, "hit" if hit else "plain", slot, argb[i]))
                i += 1
        used = [[set() for _ in range(5)] for _ in range(n_groups)]
        for at, kind, a, b in ops:
            u = used[of[at]]
            if kind == "copy":
                u[0].add(256 + self.number(a)[0])
                u[4].add(self.number(b)[0])
            elif kind == "hit":
                u[0].add(280 + a)
            else:
                for k, s in enumerate((8, 16, 0, 24)):
                    u[k].add(b >> s & 255)
        green = 280 + (1 << cache_bits if cache_bits else 0)
        codes = [[self.code(u[k] or {0}, size) for k, size in enumerate((green, 256, 256, 256, 40))] for u in used]
        for at, kind, a, b in ops:
            c = codes[of[at]]
            if kind == "copy":
                for table, prefix_base, value in ((c[0], 256, a), (c[4], 0, b)):
                    prefix, extra, n = self.number(value)
                    self.out.put(*table[prefix_base + prefix])
                    self.out.put(extra, n)
            elif kind == "hit":
                self.out.put(*c[0][280 + a])
            else:
                for k, s in enumerate((8, 16, 0, 24)):
                    self.out.put(*c[k][b >> s & 255])

    def stream(self, image, transforms, cache_bits, groups):
        """``image`` (height, width) of ARGB numbers, with forward transforms applied in order."""
        height, width = image.shape
        self.out.put(0x2F, 8)
        self.out.put(width - 1, 14)
        self.out.put(height - 1, 14)
        self.out.put(1, 1)
        self.out.put(0, 3)
        now = image.astype(np.int64)
        split = lambda a: [a >> s & 255 for s in (24, 16, 8, 0)]
        join = lambda a, r, g, b: (a & 255) << 24 | (r & 255) << 16 | (g & 255) << 8 | b & 255
        for kind in transforms:
            self.out.put(1, 1)
            self.out.put(kind, 2)
            h, w = now.shape
            if kind == webp.SUBTRACT_GREEN:
                a, r, g, b = split(now)
                now = join(a, r - g, g, b - g)
            elif kind == webp.PALETTE:
                palette = sorted(set(now.ravel().tolist()))
                index = np.searchsorted(palette, now)
                self.out.put(len(palette) - 1, 8)
                deltas = [join(*(np.diff(c, prepend=0))) for c in [split(np.array(palette))]]
                self.image(deltas[0].tolist(), len(palette))
                k = 3 if len(palette) <= 2 else 2 if len(palette) <= 4 else 1 if len(palette) <= 16 else 0
                packed = np.zeros((h, -(-w // (1 << k))), np.int64)
                for x in range(w):
                    packed[:, x >> k] |= index[:, x] << ((8 >> k) * (x & ((1 << k) - 1)))
                now = 0xFF000000 | packed << 8
            else:
                self.out.put(0, 3)
                columns, rows = -(-w // 4), -(-h // 4)
                if kind == webp.PREDICTOR:
                    modes = [[self.r.randrange(14) for _ in range(columns)] for _ in range(rows)]
                    self.image([0xFF000000 | m << 8 for row in modes for m in row], columns)
                    pixels = [[tuple(int(c) for c in webp._channels(int(v))) for v in row] for row in now]
                    rest = [[tuple(p - q & 255 for p, q in zip(pixels[y][x], webp.predictions(pixels, modes, 2, x, y))) for x in range(w)] for y in range(h)]  # noqa: B905
                    v = np.array(rest, np.int64).reshape(h, w, 4)
                    now = join(*(v[..., i] for i in range(4)))
                else:
                    e = np.array([[0xFF000000 | self.r.randrange(1 << 24) for _ in range(columns)] for _ in range(rows)])
                    self.image(e.ravel().tolist(), columns)
                    of = e[np.arange(h)[:, None] >> 2, np.arange(w)[None, :] >> 2]
                    _, red_blue, green_blue, green_red = split(of)
                    a, r, g, b = split(now)
                    now = join(a, r - webp.colour_delta(green_red, g), g, b - webp.colour_delta(green_blue, g) - webp.colour_delta(red_blue, r))
        self.out.put(0, 1)
        self.image(now.ravel().tolist(), now.shape[1], True, cache_bits, groups)
        n = -(-self.out.n // 8)
        return self.out.value.to_bytes(n, "little")


@pytest.mark.parametrize("seed", range(24))
def test_decoder_inverts_every_feature(seed):
    r = random.Random(seed)
    h, w = r.randint(1, 13), r.randint(1, 17)
    colours = [r.randrange(1 << 32) for _ in range(r.choice([1, 2, 3, 4, 9, 16, 30]))]
    image = np.array([[r.choice(colours) for _ in range(w)] for _ in range(h)], np.uint32)
    kinds = [k for k in (webp.PALETTE, webp.PREDICTOR, webp.CROSS_COLOUR, webp.SUBTRACT_GREEN) if r.random() < 0.5]
    data = Encoder(seed).stream(image, kinds, r.choice([0, 0, 1, 4, 11]), r.random() < 0.5)
    assert np.array_equal(webp.decode_stream(data), image)
    with pytest.raises(ValueError):
        webp.decode_stream(data[: len(data) // 3])


# --- urls ------------------------------------------------------------------------------------------


BLOCKED = "free-bets.example.org"  # no rule fits it


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), v, h + p) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    listed = any(host == d or host.endswith("." + d) for d in url_filter.BLOCKLIST)
    best = max(fits, default=(0, "block" if listed else "allow", None))
    return host, path, best[2], best[1]


@pytest.mark.parametrize("part_bytes", [1 << 26, 4])
def test_urls_match_brute_force(spark, monkeypatch, part_bytes):
    """In one cascade, and in several parts."""
    monkeypatch.setattr(url_filter, "PART_BYTES", part_bytes)
    blocked = spark.createDataFrame([(d,) for d in (*url_filter.BLOCKLIST, url_filter.BLOCKLIST[0], None)], "key string")
    r = random.Random(2)
    hosts = ["com", "example.com", "WWW.Example.com", "a.net", "net", "www.free-bets.example.org", "xfree-bets.example.org", "spam-farm.example.org", "x.org", "", "é.net"]
    paths = ["", "/", "/en/", "/en", "/fr/x", "/es/?a=/fr/", "?x", "#y/en/", "/en/#z"]
    urls = [f"{r.choice(['http', 'ftp', ''])}{r.choice(['://', '://', ':/'])}{r.choice(hosts)}{r.choice(paths)}" for _ in range(300)] + [None, ""]
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, None, "x", "y"), (0, urls[0], "x", "y")]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, key string, listed string"), blocked).collect()
    assert len(got) == len(rows)
    for x in got:
        if x.page_id is not None:
            assert (x.host, x.path, x.rule, x.verdict) == brute_url(urls[x.page_id])
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"), blocked).count() == 0
    long = "http://" + "a." * 3000 + BLOCKED + "/" + "p" * 50_000
    few = spark.createDataFrame([(1, long), (2, "http://" + BLOCKED)], "page_id long, url string")
    assert [x.verdict for x in url_filter.filter_urls(few, blocked).collect()] == ["block", "block"]
    assert [x.verdict for x in url_filter.filter_urls(few, blocked.limit(0)).collect()] == ["allow", "allow"]


def test_cascade_is_exact_on_its_universe(spark):
    universe = [f"k{i}.example" for i in range(6000)]
    listed = universe[::7] + ["absent.example"]
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    inside, outside = url_filter._hashed(frame(listed)), url_filter._hashed(frame([k for k in universe if k not in set(listed)]))
    levels = url_filter.build_cascade(inside.select("h1", "h2"), outside.select("h1", "h2"))
    assert len(levels) > 1
    h = frame(universe).select("key", *url_filter.hash_pair(url_filter.F.col("key"))).toPandas()
    found = url_filter.is_listed(levels, h.iloc[:, 1].to_numpy(np.int64), h.iloc[:, 2].to_numpy(np.int64))
    assert dict(zip(h["key"], found, strict=True)) == {k: k in set(listed) for k in universe}


# --- language model --------------------------------------------------------------------------------


def plain_likelihood(hmm, z):
    alpha, like = hmm.start * hmm.emit[z[0]], 0.0
    for c in z[1:]:
        alpha = (alpha @ hmm.step) * hmm.emit[c]
        s = alpha.sum()
        alpha, like = alpha / s, like + math.log(s)
    return like + math.log(alpha.sum())


def test_blocks_give_exact_likelihood_and_counts(monkeypatch):
    monkeypatch.setattr(hmm_lm, "BLOCK", 5)
    rng = np.random.default_rng(1)
    k = hmm_lm.STATES
    hmm = hmm_lm.Hmm.from_counts(rng.random(k), rng.random((k, k)), rng.random((hmm_lm.CLASSES, k)))
    sizes = np.array([1, 2, 7, 23, 5, 6, 11])
    z = rng.integers(0, hmm_lm.CLASSES, sizes.sum())
    blocks = hmm_lm.Blocks(z, sizes)
    like = blocks.forward(hmm)
    at = np.concatenate([[0], np.cumsum(sizes)])
    assert np.allclose(like, [plain_likelihood(hmm, z[a:b]) for a, b in zip(at, at[1:])])  # noqa: B905
    whole, start, step, emit = blocks.expected(hmm)
    assert np.isclose(whole, like.sum())
    assert np.isclose(start.sum(), len(sizes)) and np.isclose(step.sum(), (sizes - 1).sum()) and np.isclose(emit.sum(), sizes.sum())
    # Expected counts by forward and backward over whole texts.
    want = np.zeros_like(emit)
    for a, b in zip(at, at[1:]):  # noqa: B905
        alpha, beta = [hmm.start * hmm.emit[z[a]]], [np.ones(k)]
        for c in z[a + 1 : b]:
            alpha.append((alpha[-1] @ hmm.step) * hmm.emit[c])
        for c in z[b - 1 : a : -1]:
            beta.append(hmm.step @ (hmm.emit[c] * beta[-1]))
        for c, x, y in zip(z[a:b], alpha, beta[::-1]):  # noqa: B905
            want[c] += x * y / (x * y).sum()
    assert np.allclose(want, emit, atol=1e-4)


def test_baum_welch_raises_the_likelihood(spark):
    rows = [(i, prose(i % 7, 30), "en", "a", 0) for i in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    total = []
    old = hmm_lm.ROUNDS
    for n in (0, 2):
        hmm_lm.baum_welch.__defaults__ = (n,)
        total.append(sum(r.score for r in hmm_lm.score_texts(docs).where("not held_out").collect()))
    hmm_lm.baum_welch.__defaults__ = (old,)
    assert total[1] > total[0]


def test_base_scores_match_brute_force(edge_docs, clashing_docs, empty_docs):
    tokens = [(i, hmm_lm.tokenize(t)) for i, t, *_ in edge_rows()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 4)) for i, t in tokens), key=repr)
    for d in (edge_docs, clashing_docs):
        rows = hmm_lm.score_texts(d).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows), key=repr) == want
        assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert hmm_lm.score_texts(empty_docs).count() == 0


def test_states_learn_two_vocabularies(spark):
    """Texts of two languages without a common word: held-out texts gain over the base by far, and by the states."""
    r = random.Random(6)
    words = [[prose(1000 * k + i, 1) + "xy"[k] for i in range(60)] for k in (0, 1)]
    rows = [(i, " ".join(r.choice(words[i % 2]) for _ in range(40)), "en", "a", 0) for i in range(300)]
    out = [x for x in hmm_lm.score_texts(spark.createDataFrame(rows, SCHEMA)).collect() if x.held_out]
    tokens = sum(x.n_tokens for x in out)
    assert sum(x.score - x.base_score for x in out) > 0.2 * tokens  # half the words are out of question: log10 of 2 is 0.30


def test_model_is_a_distribution(spark):
    """All texts of one word, by brute force: known words, and unseen ones of every shape, sum to the first token's 1."""
    rows = [(i, prose(i, 12), "en", "a", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    seen = {w for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.split()}
    # One token a text: the text's end, which follows a word, is counted out by comparing with and without it.
    probe = [(10_000 + 7 * k, w, "en", "a", 0) for k, w in enumerate(sorted(seen))]
    probe = [(next(i for i in range(p[0], p[0] + 100_000) if zlib.crc32(str(i).encode()) % 7 == 2), *p[1:]) for p in probe]
    got = hmm_lm.score_texts(docs.unionByName(spark.createDataFrame(probe, SCHEMA))).collect()
    mass = sum(10**x.score for x in got if x.doc_id >= 10_000)
    assert 0 < mass < 1


# --- packing ---------------------------------------------------------------------------------------


def brute_best_fit(items, capacity):
    bins = []
    out = []
    for size, source, cluster in items:
        fits = [(left, stamp, k) for k, (left, s, c, stamp) in enumerate(bins) if left >= size and source not in s and (cluster is None or cluster not in c)]
        if fits:
            k = min(fits)[2]
        else:
            k = len(bins)
            bins.append([capacity, set(), set(), 0])
        bins[k][0] -= size
        bins[k][1].add(source)
        bins[k][2].add(cluster)
        bins[k][3] = len(out)
        out.append(k)
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from("abcdef"), st.sampled_from([None, 1, 2, 3])), max_size=60))
def test_best_fit_finds_the_tightest_compatible_bin(items):
    got = packing.best_fit([i[0] for i in items], [i[1] for i in items], [i[2] for i in items], 20)
    assert got == brute_best_fit(items, 20)


def check_bins(rows, bins, capacity):
    words = Counter()
    source, text = {}, {}
    for i, t, _, s, _ in rows:
        words[i] += len((t or "").encode().split()) + 1
        source[i], text[i] = s, " ".join((t or "").encode().decode().split())
    taken = Counter()
    for r in bins:
        taken[r.doc_id] += r.n_tokens
    assert taken == words
    by_bin = {}
    for r in bins:
        by_bin.setdefault(r.bin_id, []).append(r)
    for held in by_bin.values():
        assert sum(r.n_tokens for r in held) <= capacity
        assert len({source[r.doc_id] for r in held}) == len(held)
        full = [text[r.doc_id] for r in held if text[r.doc_id]]
        assert len(set(full)) == len(full)
        assert sorted(r.slot for r in held) == list(range(len(held)))


def test_repeated_rows_are_dealt_to_all_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ITEMS", 100)
    docs = spark.createDataFrame([(7, "same words here", "en", f"s{i % 3}", 0) for i in range(1000)], SCHEMA)
    bins = packing.pack(docs).collect()
    shards = Counter(r.bin_id >> 32 for r in bins)
    assert len(bins) == 1000 and len(shards) == 10 and max(shards.values()) < 200


def test_hot_source_is_packed_in_good_time():
    import time

    n = 40_000
    began = time.process_time()
    bins = packing.best_fit([10] * n, ["hot" if i % 3 else f"s{i % 17}" for i in range(n)], [None] * n, 2048)
    assert time.process_time() - began < 20 and len(set(bins)) == Counter("hot" if i % 3 else f"s{i % 17}" for i in range(n))["hot"]


def test_packing_keeps_its_rules(spark, edge_docs, clashing_docs, empty_docs, monkeypatch):
    check_bins(edge_rows(), packing.pack(edge_docs).collect(), packing.CAPACITY)
    check_bins(edge_rows(), packing.pack(clashing_docs).collect(), packing.CAPACITY)
    assert packing.pack(empty_docs).count() == 0
    monkeypatch.setattr(packing, "SHARD_ITEMS", 50)
    rows = [(i, prose(i % 90, 5 + i % 40), "en", "hot" if i % 3 == 0 else f"s{i % 11}", 0) for i in range(300)]
    check_bins(rows, packing.pack(spark.createDataFrame(rows, SCHEMA), 64).collect(), 64)


@pytest.mark.parametrize("limit", [7, 11])
def test_code_lengths_are_those_of_a_heap(limit):
    import heapq

    r = random.Random(limit)
    for _ in range(200):
        counts = np.array([r.choice([0, r.randint(1, 3), r.randint(1, 10**6)]) for _ in range(r.randint(3, 100))] + [1, 1])
        used = np.flatnonzero(counts).tolist()
        weights, depth = counts[used].tolist(), []
        while not depth or max(depth) > limit:
            if depth:
                weights = [(w + 1) // 2 for w in weights]
            heap, depth = [(w, k, [k]) for k, w in enumerate(weights)], [0] * len(used)
            for n in range(len(used), 2 * len(used) - 1):
                (x, _, p), (y, _, q) = heapq.nsmallest(2, heap)
                heap = [h for h in heap if h[2] is not p and h[2] is not q] + [(x + y, n, p + q)]
                for k in p + q:
                    depth[k] += 1
        got = webp.code_lengths(counts, limit)
        assert [got[s] for s in used] == depth and sum(map(bool, got)) == len(used)
