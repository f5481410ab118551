"""User patterns are written in the RE2 dialect; Spark evaluates java.util.regex.

A pattern is read into a small syntax tree, which decides both whether RE2
would accept it (if not, the pattern is dropped with a warning, as the rule-set
compiler expects) and how it is written for Java. What differs between the
dialects is settled by the tree, not by the text: flags are followed into and
out of groups, so `$`, `^`, `.`, `\\b` and case folding are printed by the flags
in force where they stand; classes are read into items and printed from them,
so quoting and set operators of Java can't appear by accident; lazy and greedy
are printed by the `U` flag; literals from `\\Q..\\E` are literals.
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass, field, replace

import regex as unicode_regex

log = logging.getLogger(__name__)

# What the class escapes stand for, as ranges; the greatest repeat count; POSIX class names.
DIGIT = (("0", "9"),)
SPACE = (("\t", "\n"), ("\f", "\r"), (" ", " "))
WORD = (("0", "9"), ("A", "Z"), ("_", "_"), ("a", "z"))
PERL = {"d": DIGIT, "s": SPACE, "w": WORD}
POSIX = {
    "alnum": (("0", "9"), ("A", "Z"), ("a", "z")), "alpha": (("A", "Z"), ("a", "z")), "ascii": (("\0", "\x7f"),),
    "blank": (("\t", "\t"), (" ", " ")), "cntrl": (("\0", "\x1f"), ("\x7f", "\x7f")), "digit": DIGIT,
    "graph": (("!", "~"),), "lower": (("a", "z"),), "print": ((" ", "~"),),
    "punct": (("!", "/"), (":", "@"), ("[", "`"), ("{", "~")), "space": (("\t", "\r"), (" ", " ")),
    "upper": (("A", "Z"),), "word": WORD, "xdigit": (("0", "9"), ("A", "F"), ("a", "f")),
}
CONTROL = {"a": "\x07", "f": "\f", "t": "\t", "n": "\n", "r": "\r", "v": "\x0b"}
MOST_REPEATS = 1000
MOST_DEPTH = 1000
CATEGORIES = "C Cc Cf Co Cs L Ll Lm Lo Lt Lu M Mc Me Mn N Nd Nl No P Pc Pd Pe Pf Pi Po Ps S Sc Sk Sm So Z Zl Zp Zs".split()


class PatternError(ValueError):
    pass


# --- the tree ---------------------------------------------------------------------


@dataclass(frozen=True)
class Flags:
    i: bool = False  # fold case
    m: bool = False  # ^ and $ at line ends
    s: bool = False  # . matches the line end
    U: bool = False  # lazy and greedy swapped


@dataclass(frozen=True)
class Literal:
    char: str
    flags: Flags


@dataclass(frozen=True)
class Dot:
    flags: Flags


@dataclass(frozen=True)
class Edge:
    """^ $ A z b B"""
    kind: str
    flags: Flags


@dataclass(frozen=True)
class Chars:
    """A class: ranges, and named sets as (Java text, negated)."""
    ranges: tuple[tuple[str, str], ...]
    sets: tuple[tuple[str, bool], ...]
    negated: bool
    flags: Flags


@dataclass(frozen=True)
class Repeat:
    node: object
    low: int
    high: int | None
    lazy: bool


@dataclass(frozen=True)
class Group:
    node: object
    name: str | None
    captured: bool


@dataclass(frozen=True)
class Sequence:
    nodes: tuple = ()


@dataclass(frozen=True)
class Choice:
    nodes: tuple = ()


# --- reading ------------------------------------------------------------------------


@dataclass
class Reader:
    text: str
    at: int = 0
    depth: int = 0
    names: set[str] = field(default_factory=set)

    def peek(self, s: str) -> bool:
        return self.text.startswith(s, self.at)

    def take(self, s: str) -> bool:
        if self.peek(s):
            self.at += len(s)
            return True
        return False

    def match(self, pattern: str) -> re.Match | None:
        m = re.compile(pattern, re.ASCII).match(self.text, self.at)
        if m:
            self.at = m.end()
        return m

    def next(self, what: str) -> str:
        if self.at >= len(self.text):
            raise PatternError(f"missing {what} at the end")
        self.at += 1
        return self.text[self.at - 1]

    def choice(self, flags: Flags) -> tuple[object, Flags]:
        """Alternatives up to ) or the end; flags set inside hold in the alternatives after them."""
        branches = []
        while True:
            node, flags = self.sequence(flags)
            branches.append(node)
            if not self.take("|"):
                break
        return (branches[0] if len(branches) == 1 else Choice(tuple(branches))), flags

    def sequence(self, flags: Flags) -> tuple[Sequence, Flags]:
        nodes: list = []
        repeated = False
        while self.at < len(self.text) and not self.peek("|") and not self.peek(")"):
            count = self.repeat()
            if count:
                if not nodes or nodes[-1] is None:
                    raise PatternError(f"nothing to repeat at {self.at}")
                if repeated:
                    raise PatternError(f"repeat of a repeat at {self.at}")
                low, high = count
                lazy = self.take("?") != flags.U
                nodes[-1] = Repeat(nodes[-1], low, high, lazy)
                if most_copies(nodes[-1]) > MOST_REPEATS:
                    raise PatternError("repeat counts beyond the limit")
                repeated = True
                continue
            repeated = False
            if self.take("(?"):
                node, flags = self.special_group(flags)
            elif self.take("("):
                node = self.group(flags, None, True)
            elif self.take("\\Q"):
                end = self.text.find("\\E", self.at)
                quoted = self.text[self.at:] if end < 0 else self.text[self.at:end]
                self.at = len(self.text) if end < 0 else end + 2
                nodes += [Literal(c, flags) for c in quoted]
                continue
            else:
                node = self.atom(flags)
            nodes.append(node)  # None: flags only, nothing that can be repeated
        return Sequence(tuple(n for n in nodes if n is not None)), flags

    def repeat(self) -> tuple[int, int | None] | None:
        for s, count in (("*", (0, None)), ("+", (1, None)), ("?", (0, 1))):
            if self.take(s):
                return count
        m = self.match(r"\{([0-9]+)(?:(,)([0-9]*))?\}")  # any other brace is a literal
        if not m:
            return None
        low = int(m[1])
        high = low if not m[2] else int(m[3]) if m[3] else None
        if low > MOST_REPEATS or (high is not None and (high > MOST_REPEATS or high < low)):
            raise PatternError(f"bad repeat count {m[0]}")
        return low, high

    def special_group(self, flags: Flags) -> tuple[object | None, Flags]:
        m = self.match(r"P?<([A-Za-z0-9_]+)>")
        if m:
            if m[1] in self.names:
                raise PatternError(f"name {m[1]} given twice")
            self.names.add(m[1])
            return self.group(flags, m[1], True), flags
        m = self.match(r"([imsU]*)(?:-([imsU]+))?([:)])")
        if not m or (m[3] == ")" and not m[1] and not m[2]):
            raise PatternError(f"unknown group at {self.at}")
        new = replace(flags, **dict.fromkeys(m[1], True) | dict.fromkeys(m[2] or "", False))
        return (None, new) if m[3] == ")" else (self.group(new, None, False), flags)

    def group(self, flags: Flags, name: str | None, captured: bool) -> Group:
        self.depth += 1
        if self.depth > MOST_DEPTH:
            raise PatternError("groups nested too deeply")
        node, _ = self.choice(flags)
        if not self.take(")"):
            raise PatternError("missing )")
        self.depth -= 1
        return Group(node, name, captured)

    def atom(self, flags: Flags) -> object:
        c = self.next("an expression")
        if c == ".":
            return Dot(flags)
        if c in "^$":
            return Edge(c, flags)
        if c == "[":
            return self.chars(flags)
        if c != "\\":
            return Literal(c, flags)
        e = self.next("an escaped character")
        if e in "AzbB":
            return Edge(e, flags)
        if e in "pP":
            return Chars((), (self.category(e == "P"),), False, flags)
        if e.lower() in PERL:
            return Chars(PERL[e.lower()], (), e.isupper(), replace(flags, i=False))
        return Literal(self.escaped(e), flags)

    def escaped(self, e: str) -> str:
        if e in CONTROL:
            return CONTROL[e]
        if e == "x":
            m = self.match(r"\{([0-9A-Fa-f]+)\}|([0-9A-Fa-f]{2})")
            if not m or int(m[1] or m[2], 16) > 0x10FFFF:
                raise PatternError("bad hexadecimal escape")
            return chr(int(m[1] or m[2], 16))
        if e == "0" or (e in "1234567" and self.match(r"(?=[0-7])")):  # a lone 1 to 7 would be a back reference
            return chr(int(e + self.match(r"[0-7]{0,2}")[0], 8))
        if e < "\x80" and not e.isalnum():
            return e
        raise PatternError(f"unknown escape \\{e}")

    def category(self, negated: bool) -> tuple[str, bool]:
        m = self.match(r"\{(\^?)([A-Za-z_]+)\}|([A-Za-z])")
        if not m:
            raise PatternError("bad character category")
        name = m[2] or m[3]
        if name not in CATEGORIES:
            if name != "Any" and not _is_script(name):
                raise PatternError(f"unknown category {name}")
            return (r"\x{0}-\x{10FFFF}" if name == "Any" else rf"\p{{Is{name}}}"), negated != bool(m[1])
        return rf"\p{{{name}}}", negated != bool(m[1])

    def chars(self, flags: Flags) -> Chars:
        negated = self.take("^")
        ranges, sets = [], []
        first = True
        while first or not self.peek("]"):
            first = False
            m = self.match(r"\[:(\^?)([a-z]+):\]")
            if m:
                if m[2] not in POSIX:
                    raise PatternError(f"unknown class {m[0]}")
                ranges += complement(POSIX[m[2]]) if m[1] else POSIX[m[2]]
                continue
            m = self.match(r"\\([dswDSW])")
            if m:
                ranges += complement(PERL[m[1].lower()]) if m[1].isupper() else PERL[m[1]]
                continue
            m = self.match(r"\\([pP])")
            if m:
                sets.append(self.category(m[1] == "P"))
                continue
            low = self.char()
            high = low
            if self.peek("-") and self.text[self.at + 1:self.at + 2] not in ("", "]"):
                self.at += 1
                high = self.char()
            if high < low:
                raise PatternError(f"bad range {low}-{high}")
            ranges.append((low, high))
        self.at += 1
        return Chars(tuple(ranges), tuple(sets), negated, flags)

    def char(self) -> str:
        c = self.next("]")
        return self.escaped(self.next("an escaped character")) if c == "\\" else c


def _is_script(name: str) -> bool:
    try:
        return bool(unicode_regex.compile(rf"\p{{Script={name}}}")) and name[0].isupper()
    except unicode_regex.error:
        return False


def complement(ranges) -> list[tuple[str, str]]:
    out, at = [], 0
    for low, high in sorted(ranges):
        if ord(low) > at:
            out.append((chr(at), chr(ord(low) - 1)))
        at = max(at, ord(high) + 1)
    return [*out, (chr(at), "\U0010ffff")] if at <= 0x10FFFF else out


def most_copies(node: object) -> int:
    """How many copies of a part nested counted repeats ask for."""
    if isinstance(node, Repeat):
        return max(node.high or node.low, 1) * most_copies(node.node)
    if isinstance(node, Group):
        return most_copies(node.node)
    if isinstance(node, (Sequence, Choice)):
        return max(map(most_copies, node.nodes), default=1)
    return 1


def parse(pattern: str) -> object:
    """The syntax tree of an RE2 pattern; PatternError when RE2 refuses it."""
    reader = Reader(pattern)
    node, _ = reader.choice(Flags())
    if reader.at < len(pattern):
        raise PatternError("unexpected )")
    return node


# --- writing --------------------------------------------------------------------------


def _char(c: str) -> str:
    return c if c.isalnum() and c < "\x80" else rf"\x{{{ord(c):X}}}"


def _chars(node: Chars) -> str:
    """A class as Java evaluates it fast: of a class and its complement the one of fewer ranges, and single
    characters, which are one table lookup there, instead of several ranges, each of which is a call a character."""
    ranges, negated, fold = node.ranges, node.negated, node.flags.i
    if ranges and not node.sets:
        kept = complement(complement(ranges))  # sorted, merged
        rest = complement(kept)
        if fold and negated and rest and rest[-1][1] < "\x80":
            # what has no case variant in the class: here only ASCII, whose variants are known
            own = {chr(c) for a, b in rest for c in range(ord(a), ord(b) + 1)}
            ranges, negated, fold = [(c, c) for c in sorted(own) if c.upper() in own and c.lower() in own], False, False
        elif not fold and rest and len(rest) < len(kept):
            ranges, negated = rest, not negated
        elif not fold:
            ranges = kept
    if not fold and sum(a != b for a, b in ranges) > 1:
        ranges = [r for a, b in ranges for r in ([(chr(c), chr(c)) for c in range(ord(a), ord(b) + 1)] if b <= "\xff" else [(a, b)])]
    body = "".join(_char(a) if a == b else f"{_char(a)}-{_char(b)}" for a, b in ranges)
    for name, without in node.sets:
        body += (f"[^{name}]" if without else name)
    if not body:
        if node.ranges:
            return "(?!)"  # no character is left
        raise PatternError("empty class")
    return f"(?iu:[{'^' * negated}{body}])" if fold else f"[{'^' * negated}{body}]"


def _first(node: object) -> tuple[set[str], bool] | None:
    """The ASCII characters with which whatever the node matches may begin, and whether others may, too; None: any, or it may be empty."""
    if isinstance(node, (Literal, Chars)):
        ranges = ((node.char, node.char),) if isinstance(node, Literal) else node.ranges
        if isinstance(node, Chars) and (node.negated or node.sets or not ranges):
            return None
        if node.flags.i and any(b > "\x7f" for _, b in ranges):
            return None  # its variants may be anything
        own = {chr(c) for a, b in ranges for c in range(ord(a), min(ord(b), 127) + 1)}
        folds = node.flags.i and any(c.isalpha() for c in own)
        return (own | {x for c in own for x in c.lower() + c.upper()} if folds else own), folds or any(b > "\x7f" for _, b in ranges)
    if isinstance(node, Repeat):
        return _first(node.node) if node.low else None
    if isinstance(node, Group):
        return _first(node.node)
    if isinstance(node, Sequence):
        return next((_first(n) for n in node.nodes if not isinstance(n, Edge)), None)
    if isinstance(node, Choice) and node.nodes:
        firsts = [_first(n) for n in node.nodes]
        return None if None in firsts else (set().union(*(f[0] for f in firsts)), any(f[1] for f in firsts))
    return None


def _ahead(node: object) -> str:
    """One comparison before what is costly to try at every character."""
    first = _first(node)
    if first is None:
        return ""
    return "(?=[" + "".join(map(_char, sorted(first[0]))) + r"\x{80}-\x{10FFFF}" * first[1] + "])"


def _ends_before(run: object, rest: tuple) -> bool:
    """Whether a run of characters can't go on with what must follow it, so that nothing of it ever has to be given back."""
    if not isinstance(run, Repeat) or run.lazy or run.high == run.low or not isinstance(run.node, (Chars, Literal)):
        return False
    own, then = _first(run.node), _first(Sequence(rest))
    return own is not None and then is not None and not own[0] & then[0] and not (own[1] and then[1])


# \w of Java is ASCII, as in RE2
_EDGES = {"A": r"\A", "z": r"\z", "b": r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))", "B": r"(?:(?<=\w)(?=\w)|(?<!\w)(?!\w))"}


def _java(node: object) -> str:
    if isinstance(node, Literal):
        return f"(?iu:{_char(node.char)})" if node.flags.i and node.char.lower() != node.char.upper() else _char(node.char)
    if isinstance(node, Dot):
        return r"(?s:.)" if node.flags.s else r"[^\n]"
    if isinstance(node, Edge):
        if node.kind in "^$":
            if node.flags.m:
                return r"(?<![^\n])" if node.kind == "^" else r"(?![^\n])"
            return r"\A" if node.kind == "^" else r"\z"
        return _EDGES[node.kind]
    if isinstance(node, Chars):
        return _chars(node)
    if isinstance(node, Repeat):
        inner = _java(node.node)
        if isinstance(node.node, (Sequence, Choice, Repeat)) or (isinstance(node.node, Edge)):
            inner = f"(?:{inner})"
        if (node.low, node.high) in ((0, None), (1, None), (0, 1)):
            count = {(0, None): "*", (1, None): "+", (0, 1): "?"}[node.low, node.high]
        else:
            count = f"{{{node.low}}}" if node.high == node.low else f"{{{node.low},{'' if node.high is None else node.high}}}"
        return inner + count + "?" * node.lazy
    if isinstance(node, Group):
        return ("(" if node.captured else "(?:") + _java(node.node) + ")"
    parts = [_java(n) for n in node.nodes]
    if isinstance(node, Sequence):
        for i, (a, b) in enumerate(zip(node.nodes, node.nodes[1:])):
            if isinstance(a, Edge) and a.kind in "bB" and isinstance(b, Literal) and not b.flags.i:
                parts[i] = f"(?={_char(b.char)})" + parts[i]  # one comparison before the four looks around
            elif isinstance(a, Edge) and a.kind in "bB":
                parts[i] = _ahead(Sequence(node.nodes[i + 1:])) + parts[i]
            elif _ends_before(a, node.nodes[i + 1:]):
                parts[i] += "+"
    return "".join(parts) if isinstance(node, Sequence) else "(?:" + "|".join(parts) + ")"


def to_java(pattern: str) -> str:
    """An equivalent java.util.regex pattern; PatternError when RE2 refuses the pattern."""
    node = parse(pattern)
    several = isinstance(node, Choice) and any(isinstance(n, Sequence) and len(n.nodes) > 1 for n in node.nodes)
    return (_ahead(node) if several else "") + _java(node)


def validate(pattern: str) -> None:
    parse(pattern)


def compile_patterns(name: str, patterns: list[str] | None) -> list[tuple[str, str]]:
    """Return (original, java) pairs for the valid patterns of one rule set."""
    kept = []
    for p in patterns or []:
        try:
            kept.append((p, to_java(p)))
        except PatternError as e:
            log.warning("invalid regex pattern in filter %s: %r (%s)", name, p, e)
    return kept
