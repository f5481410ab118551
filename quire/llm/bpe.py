"""BPE encoding and decoding with word-end tokens, by backtracking over longest matches.

For each piece of normalised text an Aho-Corasick automaton over all
vocabulary strings gives the longest token at every position. The encoder
walks left to right with those, steps back to a token's longest proper prefix
token when a neighbour does not fit, and never visits a position it has
found hopeless twice, so the work is linear in the piece. Two neighbours fit
when no earlier merge would have crossed their border; that is decided from
the merge table once per pair and kept in a pair table. The result equals
merging by rank. Decoding gathers token strings from one byte table by offsets.

Defined results: null and empty texts, and texts of white space only, have no
tokens and decode to the empty string; a special token's string in a text
becomes that token, as the tokenizers library does by default.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from . import common as C

# Fixed values of the vocabulary file's pipeline: white space; below, the piece pattern and the byte alphabet.
WHITE = r"[\t-\r \u0085   -     　]"
# Letters and digits of Unicode versions after the vocabulary library's (16), which are symbols there.
LATER = ("0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
         "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 "
         "16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 "
         "1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 "
         "1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F")
# Lower-case letters that Python's tables do not know yet, as (first, last, lower-case first).
LATER_LOWER = ((0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
               (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B),
               (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB))


def piece_pattern() -> str:
    later = "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in LATER.split())
    letter, digit = rf"[\p{{L}}--[{later}]]", rf"[\p{{N}}--[{later}]]"
    return rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{digit}|[^{WHITE[1:-1]}{letter}{digit}]+"


LOWER = {a + i: chr(low + i) for a, b, low in LATER_LOWER for i in range(b - a + 1)}
END = "</w>"
# White space of Python's str.split() that the pipeline does not count as such.
NOT_WHITE = "\x1c\x1d\x1e\x1f"
# Kept words and pieces per Python worker; further ones are encoded each time (no effect on results).
KEPT = 100_000
LONGEST_KEPT = 64


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    out = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [out[b] for b in range(256)]


class Codec:
    """Encoder and decoder for one vocabulary file (its JSON text)."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        # symbols: characters, one private character for each character that ends a word
        alphabet = byte_alphabet()
        last = {c + END: chr(0xE000 + i) for i, c in enumerate(alphabet)}
        self.last_of = {c: last[c + END] for c in alphabet}
        self.bytes_to = {b: c for b, c in enumerate(alphabet)}
        plain = lambda s: s[:-5] + last[s[-5:]] if s.endswith(END) and len(s) > len(END) else s
        symbols = [c for c in alphabet if c in vocab] + [c + END for c in alphabet if c + END in vocab]
        # own numbers by merge rank: first the symbols, then one per merge
        names = symbols + [a + b for a, b in merges]
        own = {name: i for i, name in enumerate(names)}
        self.id_bytes = [vocab[n].to_bytes(4, "little") for n in names]
        self.split = [(i, i) for i in range(len(symbols))] + [(own[a], own[b]) for a, b in merges]
        self.merge = {pair: i for i, pair in enumerate(self.split) if pair[0] != pair[1] or i >= len(symbols)}
        self.fits: dict[tuple[int, int], bool] = {}
        self.length = [len(plain(n)) for n in names]
        strings = [plain(n) for n in names]
        # a token that merging by rank never leaves whole cannot be used
        usable = [i for i, (a, b) in enumerate(self.split) if i < len(symbols) or self._fit(a, b, i)]
        number = {strings[i]: i for i in usable}
        self.prefix = [-1] * len(names)
        for i in usable:
            for k in range(len(strings[i]) - 1, 0, -1):
                if (j := number.get(strings[i][:k])) is not None:
                    self.prefix[i] = j
                    break
        self.longest = ahocorasick.Automaton()
        for s, i in number.items():
            self.longest.add_word(s, i)
        self.longest.make_automaton()
        # special tokens and the table for decoding
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = added
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        text = {i: s for s, i in vocab.items()} | {i: s for s, i in added.items()}
        spaced = [(text.get(i, "") + " ").encode() for i in range(max(text) + 1)]
        self.table = np.frombuffer(b"".join(spaced), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(s) for s in spaced])]).astype(np.int64)
        self.piece = regex.compile(piece_pattern())
        self.white = regex.compile(WHITE + "+")
        self.known_words = _Known(self.encode_word)
        self.known_pieces = _Known(self.encode_piece)

    def _fit(self, left: int, right: int, limit: int = 1 << 60) -> bool:
        """May these two tokens stand side by side? (Would merging by rank keep their border?)

        Undo the later of the two merges step by step; if at any point the
        two symbols at the border have a merge that comes before the one just
        undone, that merge would have crossed the border. limit: a merge at
        or after it does not count.
        """
        while True:
            across = self.merge.get((left, right))
            if across is not None and across < limit:
                return False
            if left > right:
                inner, side = self.split[left][1], 0
                limit = min(limit, left)
            else:
                inner, side = self.split[right][0], 1
                limit = min(limit, right + 1)
            if inner == (left, right)[side]:
                # this side is a symbol; undo the other one, if it can be undone
                other = (left, right)[1 - side]
                inner = self.split[other][0] if side == 0 else self.split[other][1]
                if inner == other:
                    return True
                limit = min(limit, other + (1 if side == 0 else 0))
                side = 1 - side
            if side == 0:
                left = inner
            else:
                right = inner

    def pair_fits(self, left: int, right: int) -> bool:
        got = self._fit(left, right)
        if len(self.fits) > 1_000_000:
            self.fits.clear()
        self.fits[left, right] = got
        return got

    def encode_piece(self, piece: str) -> bytes:
        """Token ids of one piece, as little-endian 32-bit integers."""
        if not (piece.isascii() and piece.isprintable()):
            piece = "".join(map(self.bytes_to.__getitem__, piece.encode("utf-8", "surrogatepass")))
        word = piece[:-1] + self.last_of[piece[-1]]
        length, prefix, fits = self.length, self.prefix, self.fits
        n = len(word)
        best = [-1] * n
        for end, i in self.longest.iter(word):  # ends ascend, so a later match at a start is longer
            best[end - length[i] + 1] = i
        closed = set()  # positions from which no way leads to the end
        out: list[int] = []
        at, before, token = 0, -1, best[0]
        while True:
            while token >= 0:
                end = at + length[token]
                if end not in closed:
                    if before < 0:
                        break
                    ok = fits.get((before, token))
                    if ok is None:
                        ok = self.pair_fits(before, token)
                    if ok:
                        break
                token = prefix[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    return b"".join([self.id_bytes[t] for t in out])
                at, before, token = end, token, best[end]
            else:
                closed.add(at)
                token = out.pop()
                at -= length[token]
                token = prefix[token]
                before = out[-1] if out else -1

    def words(self, text: str) -> list[str]:
        """Normalised words between white space; a piece never spans white space."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").translate(LOWER)
        text = text.lower()
        if any(c in text for c in NOT_WHITE):
            return [x for x in self.white.split(text) if x]
        return text.split()

    def encode_word(self, word: str) -> bytes:
        known = self.known_pieces
        if word.isascii() and word.isalpha():
            return known[word]
        return b"".join([known[x] for x in self.piece.findall(word)])

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        known = self.known_words
        parts = self.cut.split(text) if self.cut and "<|" in text else [text]
        blob = b"".join([np.uint32(self.special[p]).astype("<u4").tobytes() if i % 2 else
                         b"".join([known[x] for x in self.words(p)]) for i, p in enumerate(parts)])
        return np.frombuffer(blob, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the token strings joined by one space."""
        if not len(ids):
            return b""
        ids = ids.astype(np.int64)
        begin = self.offset[ids]
        out = bytearray()
        for s in range(0, len(ids), 1 << 18):
            b = begin[s:s + (1 << 18)]
            out += self.table[C.spans(b, self.offset[ids[s:s + (1 << 18)] + 1] - b)].tobytes()
        return bytes(out[:-1])


class _Known(dict):
    """Strings already encoded, as id bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, key: str) -> bytes:
        got = self.encode(key)
        if len(key) <= LONGEST_KEPT and len(self) < KEPT:
            self[key] = got
        return got


_CODECS: dict[int, Codec] = {}


def codec_of(spec: str) -> Codec:
    key = hash(spec)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def encode_decode(docs: DataFrame, vocab_path: str, with_output: bool = False) -> DataFrame:
    """All columns of `docs` plus n_tokens, ids_sha256 and decoded_sha256.

    vocab_path: vocabulary file, read once on the driver and sent to the tasks
    (a file of fixed size). with_output adds the ids (array<int>) and the
    decoded text themselves.
    """
    with open(vocab_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def make(texts: list[str | None]) -> dict:
        codec = codec_of(shared.value)
        out: dict[str, list] = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")}
        for t in texts:
            ids = codec.encode(t)
            text = codec.decode(ids)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(ids.tobytes()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(text).hexdigest())
            if with_output:
                out["ids"].append(ids.astype(np.int32))
                out["decoded"].append(text.decode())
        return out

    more = ", ids array<int>, decoded string" if with_output else ""
    return C.by_text(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string" + more, make)
