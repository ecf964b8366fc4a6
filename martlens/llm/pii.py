"""Personal data: plain identifiers and, by offset-preserving deobfuscation, disguised ones.

A document goes through a chain of transducers. Each rewrites matches of one disguise (look-alike letters, spelled
digits, letters among digits, "at" and "dot") and keeps, for every character of its output, the span of source
characters it came from. The detectors then run on the normalised text and their spans are mapped back to the source.
A span found this way is added when the source spelling differs from the normalised one and no plain span of its kind
holds it. Documents without a sign of disguise skip the chain.

Every detector is linear in the text length: runs of digits or of address characters are visited once.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martlens.llm.common import slices

KINDS = ("email", "ip", "card", "phone")

# Look-alikes of ASCII letters by script, and the words for the digits 0 to 9.
LOOKALIKES = dict(zip(
    "АВЕЗКМНОРСТУХавгеіјкмнорѕстухԁһԛԝ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορυ" + "ıɑɡ",
    "ABE3KMHOPCTYXabreijkmhopsctyxdhqw" + "ABEZHIKMNOPTYXavopu" + "iag",
    strict=True,
))
DIGIT_WORDS = (
    ("zero", "oh", "null", "zéro", "cero"),
    ("one", "eins", "un", "uno"),
    ("two", "zwei", "deux", "dos"),
    ("three", "drei", "trois", "tres"),
    ("four", "vier", "quatre", "cuatro"),
    ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"),
    ("seven", "sieben", "sept", "siete"),
    ("eight", "acht", "huit", "ocho"),
    ("nine", "neun", "neuf", "nueve"),
)
# Endings of a host after a bare "at", which is an ordinary word too: the general ones in wide use and all of countries.
TOP_LEVEL = (
    "com|org|net|edu|gov|mil|int|info|biz|name|pro|aero|coop|museum|jobs|mobi|travel|tel|cat|asia|post|app|dev|xyz|online|site|"
    "shop|store|tech|cloud|blog|club|live|email|page|agency|swiss|berlin|hamburg|koeln|wien|bayern|london|paris|madrid|amsterdam|"
    "a[cdefgilmoqrstuwxz]|b[abdefghijmnorstvwyz]|c[acdfghiklmnoruvwxyz]|d[ejkmoz]|e[ceghrstu]|f[ijkmor]|g[abdefghilmnpqrstuwy]|"
    "h[kmnrtu]|i[delmnoqrst]|j[emop]|k[eghimnprwyz]|l[abcikrstuvy]|m[acdeghklmnopqrstuvwxyz]|n[acefgilopruz]|om|p[aefghklmnrstwy]|"
    "qa|r[eosuw]|s[abcdeghijklmnorstuvxyz]|t[cdfghjklmnortvwz]|u[agksyz]|v[aceginu]|w[fs]|y[et]|z[amw]")

DIGIT_OF = {w: str(d) for d, words in enumerate(DIGIT_WORDS) for w in words}
_DIGIT = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
_LABEL = r"[A-Za-z0-9-]+"
_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_DOT = r"(?:\s+(?:dot|punkt|punto)\s+|(?<!\s)\s*[\[({<]\s*(?:dot|punkt|punto|\.)\s*[\])}>]\s*)"

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A chain starts where a run of digits starts and gives nothing back, so no digit is tried twice.
CHAIN = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


# -- plain detectors ---------------------------------------------------------------------------------------------------
def emails(text: str) -> Iterator[tuple[int, int]]:
    free, after_at, at = 0, 0, text.find("@")
    while at >= 0:
        left = max(free, after_at)
        run = text[left:at]
        start = left + len(run.rstrip(_LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        after_at = at + 1
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(free, after_at))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in CHAIN.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m.group())) <= 15:
            yield m.span()


DETECTORS: tuple[tuple[str, Callable], ...] = (("email", emails), ("ip", ips), ("card", cards), ("phone", phones))

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def plain_spans(text: str) -> list[Span]:
    return sorted((s, k, e) for k, (_, find) in enumerate(DETECTORS) for s, e in find(text))


# -- transducers -------------------------------------------------------------------------------------------------------
class Aligned:
    """A text and, for each character, the source span it stands for."""

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray):
        self.text, self.start, self.end = text, start, end

    @classmethod
    def source(cls, text: str) -> Aligned:
        at = np.arange(len(text) + 1, dtype=np.int64)
        return cls(text, at[:-1], at[1:])

    def rewrite(self, pattern: re.Pattern, parts: Callable[[re.Match], list[tuple[str, int, int]] | None]) -> Aligned:
        """Replace each match by characters with the input spans they stand for; None leaves a match as it is."""
        text, start, end, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = parts(m)
            if new is None:
                continue
            text.append(self.text[at:m.start()])
            start.append(self.start[at:m.start()])
            end.append(self.end[at:m.start()])
            text.append("".join(c for c, _, _ in new))
            start.append(np.array([self.start[a] for _, a, _ in new], np.int64))
            end.append(np.array([self.end[b - 1] for _, _, b in new], np.int64))
            at = m.end()
        if not text:
            return self
        text.append(self.text[at:])
        return Aligned("".join(text), np.concatenate([*start, self.start[at:]]), np.concatenate([*end, self.end[at:]]))


def _plain_letter(c: str) -> str:
    """ASCII character that looks like ``c``; empty for an invisible one; ``c`` itself if there is none."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c == "­" or unicodedata.category(c) == "Cf":
        return ""
    if c.isdecimal():
        return str(unicodedata.decimal(c))
    if unicodedata.category(c) == "Pd":
        return "-"
    if unicodedata.category(c) == "Zs":
        return " "
    folded = unicodedata.normalize("NFKC", c)
    return folded if len(folded) == 1 and folded.isascii() else c


GLYPH = re.compile(r"[\xa0\xadıɑɡͰ-ϿЀ-ԯ؀-ۿ०-९ -⁯⁰-₟"
                   r"℀-⅏①-⓿　﹐-﹯﻿＀-￯\U0001d400-\U0001d7ff]")
SPELLED = re.compile(
    rf"(?<![^\W_])(?:plus[ ,-]+)?(?:(?:{_DIGIT}|[0-9]+|dot|point|dash|double|triple)(?![^\W_])[ ,-]*){{2,}}", re.IGNORECASE)
SPELLED_PART = re.compile(rf"plus|dot|point|dash|double|triple|{_DIGIT}|[0-9]+", re.IGNORECASE)
MIXED = re.compile(r"(?<![A-Za-z0-9])(?=[0-9]*[OolI])[OolI]*[0-9][0-9OolI]+(?![A-Za-z0-9])")
AT_BRACKET = re.compile(r"(?<!\s)\s*[\[({<]\s*(?:at|@|arroba)\s*[\])}>]\s*", re.IGNORECASE)
AT_BARE = re.compile(
    rf"(?<=[A-Za-z0-9])\s+(?:(?:at|@|arroba)\s+(?={_LABEL}(?:{_DOT}{_LABEL}|(?:\.{_LABEL})*\.(?:{TOP_LEVEL})(?![A-Za-z0-9-])))"
    rf"|(?:@|arroba)\s+(?={_LABEL}(?:\.{_LABEL})*\.[A-Za-z]{{2,}}(?![A-Za-z0-9-])))",
    re.IGNORECASE)
DOT_ANY = re.compile(rf"(?<=[A-Za-z0-9]){_DOT}(?=[A-Za-z0-9])", re.IGNORECASE)
SIGN = re.compile(rf"[\[({{<]\s{{0,9}}(?:at|@|arroba|dot|punkt|punto|\.)\s{{0,9}}[\])}}>]|\s(?:dot|punkt|punto|arroba)\s|\s@\s", re.IGNORECASE)
AT_TLD = re.compile(rf"\sat\s{{1,9}}[A-Za-z0-9.-]{{1,253}}\.(?:{TOP_LEVEL})(?![A-Za-z0-9-])", re.IGNORECASE)


_SIGNS = {"plus": "+", "dot": ".", "point": ".", "dash": "-"}


def _spells_number(m: re.Match, words: list[str]) -> bool:
    """Whether a run of digit words, numerals and sign words is to be read as one number.

    Four parts with three digit words are. Fewer are if the run begins and ends with digits and holds numerals, a plus or
    a dot word; a single digit word must stand between digits or after a plus then, or with a dot word.
    """
    n = sum(w in DIGIT_OF for w in words)
    if n >= 3 and len(words) >= 4:
        return True
    plus = words[0] == "plus" or m.string[m.start() - 1:m.start()] == "+"
    run = words[words[0] == "plus":]
    if not n or not all(w in DIGIT_OF or w.isdecimal() for w in (run[0], run[-1])):
        return False
    if "dot" in run or "point" in run:
        return True
    if n == 1 and (run[-1] in DIGIT_OF or run[0] in DIGIT_OF and not plus):
        return False
    return plus or any(w.isdecimal() for w in run)


def _digits(m: re.Match) -> list[tuple[str, int, int]] | None:
    base, out, times, at, last = m.start(), [], 1, m.start(), None
    found = list(SPELLED_PART.finditer(m.group()))
    if not _spells_number(m, [p.group().lower() for p in found]):
        return None
    for p in found:
        word, a, b = p.group().lower(), base + p.start(), base + p.end()
        # What parts a numeral of several digits from other digits stays: it may be a number of its own.
        if last and word not in _SIGNS and last.group().lower() not in _SIGNS and (len(last.group()) > 1 and last.group().isdecimal() or len(word) > 1 and word.isdecimal()):
            out += [(m.string[i], i, i + 1) for i in range(base + last.end(), a)]
        last = p
        if word in ("double", "triple"):
            times, at = (2 if word == "double" else 3), a
            continue
        if len(word) > 1 and word.isdecimal():
            out += [(c, a + i, a + i + 1) for i, c in enumerate(word)]
        else:
            out += [(_SIGNS.get(word) or DIGIT_OF.get(word, word), at if times > 1 else a, b)] * times
        times = 1
    tail = m.group()[found[-1].end():]
    return out + [(c, base + found[-1].end() + i, base + found[-1].end() + i + 1) for i, c in enumerate(tail)]


def _as_digits(m: re.Match) -> list[tuple[str, int, int]] | None:
    word = m.group()
    if 2 * sum(map(str.isdigit, word)) < len(word):
        return None
    return [("0" if c in "Oo" else "1" if c in "lI" else c, m.start() + i, m.start() + i + 1) for i, c in enumerate(word)]


def _glyph(m: re.Match) -> list[tuple[str, int, int]]:
    return [(c, m.start(), m.end()) for c in _plain_letter(m.group())]


def _one(sign: str) -> Callable[[re.Match], list[tuple[str, int, int]]]:
    return lambda m: [(sign, m.start(), m.end())]


CHAIN_OF_TRANSDUCERS = (
    (GLYPH, _glyph), (SPELLED, _digits), (MIXED, _as_digits), (AT_BRACKET, _one("@")), (AT_BARE, _one("@")), (DOT_ANY, _one(".")),
)


_MAY_SIGN = ("[", "(", "{", "<", "dot", "punkt", "punto", "arroba", "@")


def looks_disguised(text: str) -> bool:
    """Whether some transducer may change the text; plain substring tests come first, as most texts end there."""
    low = text.lower()
    padded = f" {low.replace('-', ' ').replace(',', ' ')} "
    return bool((not text.isascii() and GLYPH.search(text))
                or (any(w in low for w in _MAY_SIGN) and SIGN.search(text)) or AT_TLD.search(text)
                or (any(f" {w} " in padded for w in DIGIT_OF) and SPELLED.search(text)) or MIXED.search(text))


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and plain with added ones; by start, then kind."""
    base = plain_spans(text)
    if not looks_disguised(text):
        return base, base
    aligned = Aligned.source(text)
    for pattern, parts in CHAIN_OF_TRANSDUCERS:
        aligned = aligned.rewrite(pattern, parts)
    of_kind = [[(x, y) for x, j, y in base if j == k] for k in range(len(KINDS))]  # in order, without overlap
    added = set()
    for s, k, e in plain_spans(aligned.text):
        a, b = int(aligned.start[s]), int(aligned.end[e - 1])
        before = bisect_right(of_kind[k], a, key=itemgetter(0))
        if text[a:b] != aligned.text[s:e] and not (before and b <= of_kind[k][before - 1][1]):
            added.add((a, k, b))
    return base, sorted({*base, *added})


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# -- operator ----------------------------------------------------------------------------------------------------------
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of personal data per row of ``docs`` (doc_id, text; further columns are ignored).

    n_* count the plain spans of a kind, base_sha256 is their digest, spans lists plain and added ones with code point
    offsets, end exclusive. Null and empty texts have no spans; a null doc_id stays null; repeated rows each give a
    row. One pass without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                base, spans = all_spans(text or "")
                counts = [0] * len(KINDS)
                for _, k, _ in base:
                    counts[k] += 1
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            columns = list(zip(*rows, strict=True))
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
