"""Operator 8, personal data: anchors found by Aho-Corasick, expanded by local parsers.

One automaton finds at-signs, URL schemes, digit patterns and identifier cues.
Each hit starts a deterministic parser that widens it to the left and right and
validates it: email, IPv4 address, card number, telephone number, and beyond
these the login part of a URL, account numbers (IBAN), secrets after a cue, and numbers of
13 to 19 digits that are no card number by their check digit: accounts, and cards with a slip.

Spans are half-open, in code points; spans of one kind never overlap, and the
leftmost wins. Edge cases: null and empty texts have no spans; an empty table gives an
empty result; repeated rows get equal results; very long texts are scanned whole, in time
proportional to their length; columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import small

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "account", "secret", "number")

_DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/@:?#]+:[^\s/@?#]+@(?=[A-Za-z0-9])")
_IBAN = re.compile(r"[\s:#=]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SECRET = re.compile(r"[\x20\"']{0,2}[=:][\x20]?[\"']?([A-Za-z0-9_/+=.-]{12,})")

SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://", "redis://", "amqp://")
ACCOUNT_CUES = ("IBAN", "iban", "Iban")
SECRET_CUES = ("password", "Password", "PASSWORD", "passwd", "token", "TOKEN", "Token", "secret", "SECRET", "Secret", "api_key", "API_KEY", "apikey", "access_key")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    for a in _DIGITS:
        found.add_word(f"+{a}", ("phone", 2))
        for b in _DIGITS:
            found.add_word(f"{a}.{b}", ("ip", 3))
            for gap in ("", " ", "-"):
                found.add_word(f"{a}{gap}{b}", ("card", len(gap) + 2))
    for kind, cues in (("login", SCHEMES), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if k % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def iban(text: str) -> bool:
    """Check digits by the remainder of 97."""
    flat = text.replace(" ", "")
    return 15 <= len(flat) <= 34 and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def find(text: str, cues: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind, in order of their start."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    over = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended, kept or not
    for last, (what, width) in cues.iter(text):
        start = last + 1 - width
        if what == "at":
            if not (m := _DOMAIN.match(text, start)):
                continue
            at, floor = start, over["email"]
            while at > floor and text[at - 1] in _LOCAL:
                at -= 1
            if at < start:
                over["email"] = m.end()
                spans["email"].append((at, m.end()))
        elif what == "ip":
            at, floor = start + 1, over["ip"]  # the dot
            while at > floor and text[at - 1] in _DIGITS:
                at -= 1
            if at <= start and (m := _IP.match(text, at)):
                over["ip"] = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    spans["ip"].append(m.span())
        elif what == "card":
            if start >= over["card"] and (m := _CARD.match(text, start)):
                over["card"] = m.end()
                if m.end() - start >= 13 and 13 <= len(d := _digits(m[0])) <= 19:
                    spans["card" if luhn(d) else "number"].append(m.span())
        elif what == "phone":
            if start >= over["phone"] and (m := _PHONE.match(text, start)):
                over["phone"] = m.end()
                if 9 <= len(_digits(m[0])) <= 15:
                    spans["phone"].append(m.span())
        else:
            parse = {"login": _LOGIN, "account": _IBAN, "secret": _SECRET}[what]
            if last + 1 >= over[what] and (m := parse.match(text, last + 1)):
                span = m.span(m.re.groups)
                over[what] = span[1]
                if what == "login" or (iban(m[1]) if what == "account" else re.search("[0-9]", m[1])):
                    spans[what].append(span)
    return spans


def joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def redact(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """Each span, or union of spans that overlap, gives way to the name of the first kind in it."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, found in spans.items() for a, b in found):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, redacted: bool = False) -> DataFrame:
    """doc_id, the counts and digests of spans, all spans as text and their number, and the redacted text if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cues = automaton()
        for batch in small(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [find(t, cues) for t in texts]
            columns = [batch.column("doc_id"), *(pa.array([len(s[k]) for s in found], pa.int64()) for k in BASE_KINDS)]
            columns.append(pa.array([hashlib.sha256(joined(s, BASE_KINDS).encode()).hexdigest() for s in found], pa.string()))
            columns.append(pa.array([joined(s, KINDS) for s in found], pa.string()))
            columns.append(pa.array([sum(map(len, s.values())) for s in found], pa.int64()))
            if redacted:
                columns.append(pa.array([redact(t, s) for t, s in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_spans bigint" + ", redacted string" * redacted
    return docs.select("doc_id", "text").mapInArrow(run, schema)
