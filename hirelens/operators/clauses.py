"""From the text of a listing to clauses: a lexer that yields typed tokens, and a reader that groups them.

`tokens` reads a text once, as it is written: numbers (also in words), words, marks, and the ends
that mark-up, line feeds and lost separators leave. `Reader` walks over the tokens and closes a
piece where a requirement ends; pieces that go on from each other, as alternatives do, make one `Clause`.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

# Words of the rules.
UNITS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")
YEARS, MONTHS = ("year", "years", "yr", "yrs"), ("month", "months", "mo", "mos")
DEGREE_NAMES = ("bachelor", "bachelors", "baccalaureate", "master", "masters", "associate", "associates", "doctor", "doctorate", "doctoral", "phd", "bs", "ms", "ba", "ma", "degree")
LEADING_DEGREES = ("bachelor", "master", "associate", "doctorate", "doctoral", "phd")
OWNERSHIP, ARTICLES, CREDENTIALS, IN_FORCE = ("have", "hold", "possess"), ("a", "an"), ("certification", "license"), ("current", "active", "valid")
CREDENTIAL_KINDS = ("national", "professional", "board")
# Phrases by what they do to a clause.
PHRASES = {
    "heading": [f"{a} {b}" for a in ("preferred", "minimum", "basic", "required", "desired") for b in ("qualifications", "requirements")] + ["education and experience", "what you have"],
    "pay": ["base pay range", "salary range", "salary ranges"],
    "preference": ["preferably", "ideally", "optionally", "preferred", "desired", "optional"],
    "apart": ["additionally", "also", "furthermore", "in addition", "all applicants", "all candidates", "in all cases", "regardless of degree"],
    "wish": ["preferred", "desired", "a plus", "nice to have", "nice - to have", "nice to - have", "nice - to - have"],
    "aside": ["preferred", "a plus", "nice to have", "nice - to have", "nice to - have", "nice - to - have", "not required"],
    "way": ["bachelor", "bachelors", "baccalaureate", "master", "masters", "associate", "associates", "advanced degree", "graduate degree", "postgraduate degree", "undergraduate degree", "doctorate", "doctoral", "phd", "bs", "ms", "ba", "ma", "graduation", "proof of completion", "completion of", "equivalent combination", "combination of education"],
}

_BY_FIRST: dict[str, list[tuple[str, tuple[str, ...]]]] = defaultdict(list)
for _label, _phrases in PHRASES.items():
    for _phrase in _phrases:
        _BY_FIRST[_phrase.split()[0]].append((_label, tuple(_phrase.split())))
_NUMBERS = {w: k for k, w in enumerate(UNITS, 1)} | {w: 10 * k for k, w in enumerate(TENS, 2)}

_HIDDEN = re.compile("[\u200b-\u200f\u202a-\u202e\ufeff]")
_LEX = re.compile(
    r"(?P<end>\r\n?|\n|<br\s*/?\s*>|</(?:p|li|h[1-6])>|[;\u2022])|(?P<space>[^\S\r\n]+|<[^>]*>|&nbsp;|&\#160;)"
    r"|(?P<number>[0-9]+(?:\.[0-9]+)?)|(?P<word>[A-Za-z]+)|(?P<mark>.)",
    re.IGNORECASE | re.DOTALL,
)
#: Between words whose separator was lost: relatedExperience, USMinimum.
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z][a-z])|(?<=[A-Z]{2})(?=[A-Z][a-z])")
_MARKS = str.maketrans({**dict.fromkeys("\u2010\u2011\u2012\u2013\u2014\u2015\u2212", "-"), **dict.fromkeys("\u2018\u2019", "'")})


@dataclass
class Token:
    """kind is number, word, mark or end; space tells whether a blank stands before it."""

    kind: str
    text: str
    space: bool = False
    conflict: bool = False  # a number given twice, unlike itself
    option: bool = False  # the first of an alternative that is marked as such
    labels: dict[str, int] = field(default_factory=dict)  # how many tokens the phrase of a label has that starts here

    def among(self, words: Iterable[str]) -> bool:
        return self.kind == "word" and self.text in words


_END = Token("end", "")


def _lexed(text: str) -> Iterator[Token]:
    space = False
    for m in _LEX.finditer(_HIDDEN.sub("", text)):
        kind, own = m.lastgroup, m[0]
        if kind == "space":
            space = True
            continue
        if kind == "word":
            cuts = [0, *(h.start() for h in _HUMP.finditer(own)), len(own)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if k:
                    yield Token("end", "")
                yield Token(kind, own[a:b].lower(), space and not k)
        else:
            yield Token(kind, own.lower().translate(_MARKS) if kind == "mark" else own, space)
        space = False


class _Cursor:
    """Tokens with a sentinel beyond their end."""

    def __init__(self, tokens: list[Token]):
        self.tokens = tokens

    def __getitem__(self, k: int) -> Token:
        return self.tokens[k] if 0 <= k < len(self.tokens) else _END

    def spells(self, k: int, words: tuple[str, ...]) -> bool:
        return all(self[k + j].text == w and (not j or w == "-" or self[k + j].space or self[k + j - 1].text == "-") for j, w in enumerate(words))

    def amount(self, k: int, units: tuple[str, ...], ranges: tuple[str, ...] = ()) -> bool:
        """Whether a duration stands at k: a number, perhaps a range over one of these signs or a plus, and a unit."""
        if self[k].kind != "number":
            return False
        k += 1
        if self[k].text == "+" and "+" in ranges:
            k += 1
        elif self[k].text in ranges and self[k + 1].kind == "number":
            k += 2
        elif "" in ranges and self[k].kind == "number":
            k += 1
        return self[k + (self[k].text == "+")].among(units)


def _numbers(found: list[Token]) -> Iterator[Token]:
    """Number words as numbers, and a number that is repeated in brackets as one."""
    at, k = _Cursor(found), 0
    while k < len(found):
        t = found[k]
        alone = t.kind == "word" and t.text in _NUMBERS and not (k and not t.space and at[k - 1].kind == "number")
        if alone:
            value = _NUMBERS[t.text]
            more = k + 1 + (at[k + 1].text == "-" and not at[k + 1].space and not at[k + 2].space)
            if t.text in TENS and at[more].among(UNITS[:9]) and (more > k + 1 or at[more].space):
                value += _NUMBERS[at[more].text]
                k = more
            t = replace(t, kind="number", text=str(value))
        yield t
        k += 1


def tokens(text: str) -> list[Token]:
    """The tokens of a text; every spelling of a duration becomes one of few."""
    found = list(_numbers(list(_lexed(text))))
    at, out, k = _Cursor(found), [], 0
    units = YEARS + MONTHS
    while k < len(found):
        t = found[k]
        if t.kind == "number" and at[k + 1].text == "(" and at[k + 2].kind == "number" and at[k + 3].text == ")" and "." not in at[k + 2].text and not (at[k + 2].space or at[k + 3].space):
            out.append(replace(t, conflict=t.text != at[k + 2].text))
            k += 4
        elif t.text == "between" and at[k + 1].kind == at[k + 3].kind == "number" and at[k + 2].text == "and" and at[k + 4].among(units):
            out += [replace(at[k + 1], space=t.space), Token("mark", "-"), replace(at[k + 3], space=False)]
            k += 4
        elif t.kind == "number" and at[k + 1].text == "or" and at[k + 2].text in ("more", "greater") and at[k + 3].among(units):
            out += [t, Token("mark", "+")]
            k += 3
        elif t.text in ("b", "m") and at[k + 2].text in ("s", "a") and at[k + 1].text == at[k + 3].text == "." and not any(at[k + j].space for j in (1, 2, 3)):
            out.append(replace(t, text=t.text + at[k + 2].text))
            k += 4
        elif t.text == "ph" and at.spells(k + 1, (".",)) and at[k + 2].text == "d" and not at[k + 2].space:
            out.append(replace(t, text="phd"))
            k += 3 + (at[k + 3].text == ".")
        elif t.text == "phd" and at[k + 1].text == ".":
            out.append(t)
            k += 2
        else:
            out.append(t)
            k += 1
    whole = _Cursor(out)
    for k, t in enumerate(out):
        for label, words in _BY_FIRST.get(t.text, ()):
            if whole.spells(k, words):
                t.labels[label] = max(len(words), t.labels.get(label, 0))
    return out


def rendered(found: list[Token]) -> tuple[str, list[int]]:
    """The text of tokens with single blanks, and where each of them starts."""
    parts, starts, size = [], [], 0
    for t in found:
        gap = " " if t.space and size else ""
        starts.append(size + len(gap))
        parts.append(gap + t.text)
        size += len(parts[-1])
    return "".join(parts), starts


def plain(text: str | None) -> str:
    """Lower case, numbers as digits, no mark-up, single blanks."""
    found = tokens(text or "")
    kept, late = [], False
    for t in found:
        if t.kind == "end":
            late = True
            continue
        kept.append(replace(t, space=t.space or late))
        late = False
    return rendered(kept)[0].strip()


# -- clauses ------------------------------------------------------------------------


@dataclass(frozen=True)
class Branch:
    """An alternative of a clause, and where it stands in it."""

    text: str
    start: int
    end: int
    option: bool


class Clause:
    """An independent requirement; explicit alternatives stay in one clause across marks and lines."""

    def __init__(self, found: list[Token]):
        self.tokens = found

    @cached_property
    def _rendered(self) -> tuple[str, list[int]]:
        return rendered(self.tokens)

    @property
    def text(self) -> str:
        return self._rendered[0]

    @cached_property
    def conflicts(self) -> list[int]:
        """Where the numbers start that are given twice, unlike themselves."""
        return [at for t, at in zip(self.tokens, self._rendered[1], strict=True) if t.conflict]

    def has(self, kind: str) -> bool:
        return any(t.kind == kind for t in self.tokens)

    @property
    def lead(self) -> str:
        return self.tokens[0].text if self.tokens and self.tokens[0].text in LEADING_DEGREES else ""

    @property
    def of_experience(self) -> bool:
        return any("experience" in t.text for t in self.tokens)

    @property
    def options(self) -> bool:
        return any(t.option for t in self.tokens)

    def opens_a_way(self, k: int) -> bool:
        """Whether the tokens from k on name another way to qualify."""
        at = _Cursor(self.tokens)
        while at[k].text in (",", ";", "("):
            k += 1
        first = k
        k += at[k].among(OWNERSHIP)
        k += at[k].among(ARTICLES)
        if at[k].option or at[k].kind == "number" or "way" in at[k].labels or (at.spells(k, ("at", "least")) and at[k + 2].kind == "number"):
            return True
        room = 101  # signs of the text between a word that says it is in force and the credential
        if at[first].among(IN_FORCE):
            for t in self.tokens[first + 1 :]:
                if t.text in (".", ";") or room < 0:
                    break
                if t.among(CREDENTIALS):
                    return True
                room -= len(t.text) + t.space
        for t in self.tokens[first : first + 5]:
            if t.among(CREDENTIALS):
                return True
            if t.kind != "word":
                break
        return False

    @cached_property
    def branches(self) -> list[Branch]:
        """The clause cut at each 'or' that opens another way to qualify; other alternatives do not count."""
        text, starts = self._rendered
        cuts = [k for k, t in enumerate(self.tokens) if t.text == "or" and self.opens_a_way(k + 1)]
        edges = [(-1, len(self.tokens))] if not cuts else [*zip([-1, *cuts], [*cuts, len(self.tokens)], strict=True)]
        found = []
        for a, b in edges:
            start = starts[a] + len(self.tokens[a].text) if a >= 0 else 0
            end = starts[b] if b < len(self.tokens) else len(text)
            found.append(Branch(text[start:end], start, end, any(t.option for t in self.tokens[a + 1 : b])))
        return found


@dataclass
class _Seen:
    """What a run of tokens has named so far."""

    number: bool = False
    time: bool = False  # a unit after a number
    experience: bool = False  # the word, after a number
    degree: bool = False

    def add(self, t: Token) -> None:
        self.number |= t.kind == "number"
        self.time |= self.number and t.among(("year", "years", "month", "months"))
        self.experience |= self.number and t.text == "experience"
        self.degree |= t.among(DEGREE_NAMES)


class Reader:
    """Cuts tokens into pieces. What has been taken into the open piece, and its last sentence, decides where it ends."""

    def __init__(self, found: list[Token]):
        self.at = _Cursor(found)
        self.open: list[Token] = []
        self.pieces: list[list[Token]] = []
        self.piece, self.sentence = _Seen(), _Seen()

    def close(self) -> None:
        begin = next((k for k, t in enumerate(self.open) if t.text not in ("-", "*")), len(self.open))
        if begin < len(self.open):
            self.pieces.append(self.open[begin:])
        self.open = []
        self.piece, self.sentence = _Seen(), _Seen()

    def take(self, k: int, n: int = 1) -> int:
        for t in self.at.tokens[k : k + n]:
            self.open.append(t)
            self.piece.add(t)
            if t.text == ".":
                self.sentence = _Seen()
            else:
                self.sentence.add(t)
        return k + n

    def drop_separator(self) -> None:
        if self.open and self.open[-1].text in (",", "and", "but"):
            del self.open[-1]

    def read(self) -> list[list[Token]]:
        k = 0
        while k < len(self.at.tokens):
            k = self.step(k)
        self.close()
        return self.pieces

    def step(self, k: int) -> int:
        at, t = self.at, self.at[k]
        if t.kind == "end":
            self.close()
            return k + 1
        for label, marks in (("heading", ":."), ("pay", ":")):
            if label in t.labels:
                return self.heading(k, t.labels[label], marks)
        if "apart" in t.labels:
            self.drop_separator()
            self.close()
            return k + t.labels["apart"]
        if t.text in (",", "and", "but") and "preference" in at[k + 1].labels:
            self.close()
            return k + 1
        if t.text == "," and self.piece.experience and self.degree_ahead(k + 1):
            self.close()
            return k + 1
        if t.kind == "number" and not t.space and at[k - 1].kind == "word" and at.amount(k, ("year", "years", "month", "months"), ("-", "to", "+")):
            self.close()
            return self.take(k)
        if t.kind == "mark" and self.stops(k):
            self.close()
            return k + 1
        after = k + max(t.labels.get("wish", 0), 1)
        ends = (
            ("wish" in t.labels and at.amount(after, ("year", "years", "month", "months"), ("-", "")) and self.sentence.degree and not self.sentence.time)
            or (t.text in ("required", "preferred") and self.credential_ahead(k + 1))
            or (t.text == ")" and at.amount(k + 1, ("year", "years", "month", "months")) and self.aside())
        )
        k = self.take(k, after - k if "wish" in t.labels and ends else 1)
        if ends:
            self.close()
        return k

    def heading(self, k: int, n: int, marks: str) -> int:
        self.close()
        k = self.take(k, n)
        self.open[0] = replace(self.open[0], space=False)
        self.open.append(Token("mark", ":"))
        self.close()
        while self.at[k].text and self.at[k].text in marks:
            k += 1
        return k

    def stops(self, k: int) -> bool:
        """Whether a mark ends a sentence: before a blank, at the end of a line, or where the blank was lost."""
        text, after = self.at[k].text, self.at[k + 1]
        if text not in (".", "!", "?"):
            return False
        if after.kind == "end" or (after.space and after.kind in ("word", "number")):
            return True
        glued = not after.space and text == "."
        return glued and (after.kind == "word" or (after.kind == "number" and (self.at[k - 1].kind == "word" or self.at[k - 1].text == ")")))

    def degree_ahead(self, k: int) -> bool:
        k += self.at[k].among(OWNERSHIP + ARTICLES)
        t = self.at[k]
        return t.kind == "word" and (t.text in ("bs", "ms", "ba", "ma") or t.text.startswith(("bachelor", "master", "associate", "doctor")))

    def credential_ahead(self, k: int) -> bool:
        k += self.at[k].among(CREDENTIAL_KINDS)
        return self.at[k].space and self.at[k].among((*CREDENTIALS, "degree", "bachelor", "master"))

    def aside(self) -> bool:
        """The brackets that close here hold a preference."""
        begin = next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k].text in "()"), None)
        return begin is not None and self.open[begin].text == "(" and any("aside" in t.labels for t in self.open[begin:])


def clauses(inputs: Iterable[tuple[str, str]], optional: re.Pattern[str]) -> Iterator[tuple[int, Clause]]:
    """(number of the input, clause) from inputs of (source, text).

    A piece goes on from the clause before it, in the same source, if an 'or' stands between them, if both are
    numbered options, or if both open with different degrees and name what each of them takes; optional tells preferences.
    """
    last: tuple[int, str, Clause] | None = None
    for number, (source, text) in enumerate(inputs):
        for k, piece in enumerate(Reader(tokens(text)).read()):
            piece[0] = replace(piece[0], space=False)
            if len(piece) > 3 and piece[0].text == "option" and piece[1].kind == "number" and piece[2].text == ":":
                piece = [replace(piece[3], space=False, option=True), *piece[4:]]
            if last and last[1] == source and (last[0] == number or not k):
                joint = _joint(last[2], Clause(piece), optional)
                if joint is not None:
                    if last[0] != number and piece[0].text not in ("or", "alternatively") and last[2].tokens[-1].text != "or":
                        joint = None  # alternatives without an 'or' are of one text
                if joint is not None:
                    last = (last[0], source, Clause([*last[2].tokens, *joint]))
                    continue
            if last:
                yield last[0], last[2]
            last = (number, source, Clause(piece))
    if last:
        yield last[0], last[2]


def _joint(before: Clause, piece: Clause, optional: re.Pattern[str]) -> list[Token] | None:
    """The tokens by which a piece goes on from the clause before it, or None if it does not."""
    first, rest = piece.tokens[0], piece.tokens[1:]
    if before.options and first.option:
        return [Token("word", "or", True), replace(first, space=True), *rest]
    paths = before.lead and piece.lead and before.lead != piece.lead
    if paths and before.has("number") and piece.has("number") and (before.of_experience or piece.of_experience) and not optional.search(f"{before.text} {piece.text}"):
        return [Token("word", "or", True), replace(first, space=True), *rest]
    if first.text in ("or", "alternatively"):
        return [replace(first, text="or", space=True), *rest]
    if before.tokens[-1].text == "or":
        return [replace(first, space=True), *rest]
    return None
