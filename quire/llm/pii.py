"""Personal data: base patterns, and spans that a linear-chain CRF adds to them.

The base finds e-mail addresses, IPv4 addresses, payment cards and phone
numbers by pattern. The conditional random field labels tokens from their word
shape and that of their neighbours; it is trained on a small labelled table
(`labelled_table`) by gradient steps on its exact log-likelihood, and
decoded by Viterbi over many token runs at once in numpy. A token without a
digit or `@` can only be outside, which is part of the model; so a text falls
into runs between such tokens and the runs are decoded on their own, exactly.
A span of the field is added when it has no character in common with a base
span.

Defined results: null and empty texts have no spans; repeated rows are searched
each; offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

KINDS = ("email", "ip", "card", "phone", "secret")
# The base patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    twice = str.maketrans("0123456789", "0246813579")
    return sum(map(int, digits[-1::-2])) % 10 == (-sum(map(int, digits[-2::-2].translate(twice)))) % 10


def _emails(text: str) -> list[Span]:
    """Leftmost matches, looked for at each `@` so that long runs cost no retries."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str | None) -> list[Span]:
    """Spans of the base patterns, by kind as listed, then start."""
    if not text:
        return []
    out = _emails(text) if "@" in text else []
    first = DIGIT.search(text)
    if first is None:
        return out
    i = first.start()
    if "." in text:
        out += [("ip", *m.span()) for m in IP.finditer(text, i)
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text, i):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


# --- the field ---------------------------------------------------------------------------------

LABELS = ("O", *KINDS)
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
MARKED = re.compile(r"[0-9@]")
# Names of the shape features of a token (word shapes, tested in this order).
SHAPES = ("has_at", "dotted_four", "digits_long", "digits_mid", "digits_short", "hex_long", "mixed_long", "plus",
          "parens", "dashed", "assigned", "plain", "none")
WIDTH = len(SHAPES)
ANCHOR = ("token", "key", "secret", "password", "passwd", "pwd", "api_key", "apikey")


def shape(token: str | None) -> int:
    """Bit set of SHAPES of a token; `none` beyond the ends of a text."""
    if token is None:
        return 1 << SHAPES.index("none")
    core = token.strip("\"'.,;:!?*#$%&|<>()[]{}")
    digits = sum(c.isdigit() and c.isascii() for c in core)
    bits = []
    if "@" in core and "." in core[core.find("@"):]:
        bits.append("has_at")
    if re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", core):
        bits.append("dotted_four")
    if core and digits == len(core):
        bits.append("digits_long" if digits >= 13 else "digits_mid" if digits >= 5 else "digits_short")
    if len(core) >= 24 and digits and re.fullmatch(r"[0-9a-fA-F]+", core) and digits < len(core):
        bits.append("hex_long")
    elif len(core) >= 20 and digits >= 3 and re.fullmatch(r"[0-9A-Za-z_+/=-]+", core) and digits < len(core):
        bits.append("mixed_long")
    if token.startswith("+") and digits:
        bits.append("plus")
    if token.startswith("(") and ")" in token and digits:
        bits.append("parens")
    if re.fullmatch(r"[0-9]{3,4}[-.][0-9]{3,4}([-.][0-9]{3,4})?", core):
        bits.append("dashed")
    if token == "=" or core.lower() in ANCHOR:
        bits.append("assigned")
    if not bits:
        bits.append("plain")
    return sum(1 << SHAPES.index(b) for b in bits)


def _bits(n: int) -> np.ndarray:
    return np.array([(n >> i) & 1 for i in range(WIDTH)], float)


def rows_of(tokens: list[str], lo: int, hi: int) -> np.ndarray:
    """Feature rows of tokens[lo:hi]: own shape and the shapes of two tokens on each side."""
    at = lambda i: shape(tokens[i] if 0 <= i < len(tokens) else None)
    near = [_bits(at(i)) for i in range(lo - 2, hi + 2)]
    return np.array([np.concatenate(near[k:k + 5] + [np.ones(1)]) for k in range(hi - lo)])


def labelled_table(rows: int = 240, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """The small labelled table: tokens and labels of `rows` made sentences.

    Each sentence puts one entry of a kind, or a number that is no personal
    data, between plain words.
    """
    rng = np.random.default_rng(seed)
    digits = lambda n: "".join(str(x) for x in rng.integers(0, 10, n))
    word = lambda: "".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(2, 9)))
    text = lambda alphabet, n: "".join(alphabet[x] for x in rng.integers(0, len(alphabet), n))
    small, mixed = "0123456789abcdef", "0123456789abcdefghijABCDEFGHIJ_-"
    out = []
    for i in range(rows):
        case = i % 12
        if case == 0:
            mid, lab = [f"{word()}{digits(2)}@{word()}{digits(1)}.example.org"], ["email"]
        elif case == 1:
            mid, lab = [".".join(str(x) for x in rng.integers(0, 256, 4))], ["ip"]
        elif case == 2:
            mid, lab = [digits(16)], ["card"]
        elif case == 3:
            mid, lab = ["+" + digits(1), f"({digits(3)})", f"{digits(3)}-{digits(4)}"], ["phone"] * 3
        elif case == 4:
            mid, lab = [f"({digits(3)})", f"{digits(3)}-{digits(4)}"], ["phone"] * 2
        elif case == 5:
            mid, lab = [f"{digits(3)}-{digits(3)}-{digits(4)}"], ["phone"]
        elif case == 6:
            mid, lab = ["token", "=", f'"{text(small, 40)}a1"'], ["O", "O", "secret"]
        elif case == 7:
            mid, lab = [text(mixed, 32) + "123a"], ["secret"]
        elif case == 8:
            mid, lab = [digits(rng.integers(1, 5))], ["O"]
        elif case == 9:
            mid, lab = [digits(rng.integers(1, 4)) + ".", digits(rng.integers(5, 12))], ["O", "O"]
        elif case == 10:
            mid, lab = [f"{word()}{digits(2)}", f"{digits(1)}.{digits(1)}"], ["O", "O"]
        else:
            mid, lab = [f"{digits(4)}/{digits(2)}/{digits(2)}", f"{digits(1)},{digits(3)}"], ["O", "O"]
        before, after = [word() for _ in range(rng.integers(1, 5))], [word() for _ in range(rng.integers(1, 5))]
        close = ["", ".", ",", "!!", "%%%"][rng.integers(0, 5)]
        mid = mid[:-1] + [mid[-1] + close]
        out.append((before + mid + after, ["O"] * len(before) + lab + ["O"] * len(after)))
    return out


def runs_of(tokens: list[str]) -> list[tuple[int, int]]:
    """Maximal runs of tokens that hold a digit or `@`; all others can only be outside."""
    out, start = [], None
    for i, t in enumerate([*tokens, ""]):
        if MARKED.search(t):
            start = i if start is None else start
        elif start is not None:
            out.append((start, i))
            start = None
    return out


def train(table: list[tuple[list[str], list[str]]], rounds: int = 300, rate: float = 0.5, l2: float = 1e-3) -> dict:
    """Emission weights (features x labels) and transitions by gradient ascent on the log-likelihood."""
    k = len(LABELS)
    seqs = []
    for tokens, labels in table:
        for lo, hi in runs_of(tokens):
            seqs.append((rows_of(tokens, lo, hi), [LABELS.index(x) for x in labels[lo:hi]]))
    by_len: dict[int, list] = {}
    for x, y in seqs:
        by_len.setdefault(len(y), []).append((x, y))
    groups = [(np.array([x for x, _ in g]), np.array([y for _, y in g])) for g in by_len.values()]
    width = 5 * WIDTH + 1
    emit, move = np.zeros((width, k)), np.zeros((k + 1, k + 1))  # row k: start, column k: end
    seen_e, seen_m = np.zeros_like(emit), np.zeros_like(move)
    n = sum(len(y) for _, y in groups)
    for _ in range(rounds):
        grad_e, grad_m = -l2 * emit, -l2 * move
        for x, y in groups:
            s, t, _ = x.shape
            score = x @ emit
            alpha, beta = np.zeros((t, s, k)), np.zeros((t, s, k))
            alpha[0] = move[k, :k] + score[:, 0]
            for j in range(1, t):
                alpha[j] = _lse(alpha[j - 1][:, :, None] + move[:k, :k], 1) + score[:, j]
            beta[t - 1] = move[:k, k]
            for j in range(t - 2, -1, -1):
                beta[j] = _lse(move[:k, :k] + (score[:, j + 1] + beta[j + 1])[:, None, :], 2)
            z = _lse(alpha[t - 1] + beta[t - 1], 1)
            for j in range(t):
                p = np.exp(alpha[j] + beta[j] - z[:, None])
                d = np.eye(k)[y[:, j]] - p
                grad_e = grad_e + x[:, j].T @ d / n
                if j == 0:
                    grad_m[k, :k] += d.sum(0) / n
                if j == t - 1:
                    grad_m[:k, k] += d.sum(0) / n
                else:
                    q = np.exp(alpha[j][:, :, None] + move[:k, :k] + (score[:, j + 1] + beta[j + 1])[:, None, :]
                               - z[:, None, None])
                    np.add.at(grad_m, (y[:, j], y[:, j + 1]), 1 / n)
                    grad_m[:k, :k] -= q.sum(0) / n
        seen_e += grad_e ** 2
        seen_m += grad_m ** 2
        emit = emit + rate * grad_e / (np.sqrt(seen_e) + 1e-8)
        move = move + rate * grad_m / (np.sqrt(seen_m) + 1e-8)
    return {"emit": emit, "move": move}


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def viterbi(model: dict, runs: list[np.ndarray]) -> list[np.ndarray]:
    """Best label sequence of each run; runs of one length are decoded together."""
    emit, move = model["emit"], model["move"]
    k = emit.shape[1]
    out: list[np.ndarray] = [np.zeros(0, int)] * len(runs)
    by_len: dict[int, list[int]] = {}
    for i, r in enumerate(runs):
        by_len.setdefault(len(r), []).append(i)
    for t, at in by_len.items():
        score = np.array([runs[i] for i in at]) @ emit
        best = move[k, :k] + score[:, 0]
        back = []
        for j in range(1, t):
            step = best[:, :, None] + move[:k, :k]
            back.append(step.argmax(1))
            best = step.max(1) + score[:, j]
        lab = (best + move[:k, k]).argmax(1)
        path = [lab]
        for b in reversed(back):
            lab = b[np.arange(len(at)), lab]
            path.append(lab)
        for i, row in zip(at, np.array(path[::-1]).T, strict=True):
            out[i] = row
    return out


@lru_cache(maxsize=1)
def default_model() -> dict:
    return train(labelled_table())


def field_spans(model: dict, texts: list[str | None]) -> list[list[Span]]:
    """Spans that the field finds in each text."""
    rows, where = [], []
    for d, text in enumerate(texts):
        if not text or not MARKED.search(text):
            continue
        found = list(TOKEN.finditer(text))
        tokens = [m[0] for m in found]
        for lo, hi in runs_of(tokens):
            rows.append(rows_of(tokens, lo, hi))
            where.append((d, [(found[i].start(), tokens[i]) for i in range(lo, hi)]))
    out: list[list[Span]] = [[] for _ in texts]
    for (d, tokens), labels in zip(where, viterbi(model, rows), strict=True):
        i = 0
        while i < len(labels):
            j = i + 1
            if labels[i]:
                many = LABELS[labels[i]] == "phone"  # other kinds are one token each
                while many and j < len(labels) and labels[j] == labels[i]:
                    j += 1
                (a, first), (b, last) = tokens[i], tokens[j - 1]
                start = a + len(first) - len(first.lstrip("\"'.,;:!?*#$%&|<>[]{}"))
                end = b + len(last.rstrip("\"'.,;:!?*#$%&|<>()[]{}"))
                if end > start:
                    out[d].append((LABELS[labels[i]], start, end))
            i = j
    return out


def all_spans(base: list[Span], more: list[Span]) -> list[Span]:
    """Base spans and those others that overlap none of them, by kind as listed, then start."""
    extra = [s for s in more if all(s[2] <= b[1] or s[1] >= b[2] for b in base)]
    return sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def render(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(model: dict, texts: list[str | None]) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) for t in texts]
    return base, [all_spans(b, m) for b, m in zip(base, field_spans(model, texts), strict=True)]


def personal_data(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """All columns of `docs` plus n_email, n_ip, n_card, n_phone (base), base_sha256 and spans (all)."""
    shared = docs.sparkSession.sparkContext.broadcast(model or default_model())

    def make(texts: list[str | None]) -> dict:
        base, spans = find(shared.value, texts)
        out = {f"n_{k}": [sum(s[0] == k for s in b) for b in base] for k in KINDS[:4]}
        out["base_sha256"] = [hashlib.sha256(render(b).encode()).hexdigest() for b in base]
        out["spans"] = [render(s) for s in spans]
        return out

    return C.by_text(docs, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", make)


def mask_text(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlaps become one."""
    if not text or not spans:
        return text
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def mask(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """`docs` with personal data in `text` replaced; all other columns and rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model or default_model())

    def make(texts: list[str | None]) -> dict:
        return {"_masked": [mask_text(t, s) for t, s in zip(texts, find(shared.value, texts)[1], strict=True)]}

    done = C.by_text(docs, "_masked string", make)
    return done.select(*[F.col("_masked").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
