"""Personal data in texts, also behind disguises, with spans of the source text.

Plain identifiers are found on the text itself.  Then transducers rewrite
disguises and keep, for every character written, the source characters it
stands for: look-alike characters become ASCII and invisible ones vanish,
``[at]``/``(dot)`` and spelled ``at``/``dot`` become signs, runs of spelled
digits become digits.  Identifiers found in the rewritten text that contain a
rewritten character are mapped back and added, unless a plain one of the same
kind covers them.  Spans are code points, end exclusive.

Null text counts as empty and has no spans; rows with null or repeated ids
are treated like any other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm import scan
from stellate.llm.common import column_type, documents, empty_text

KINDS = ("email", "ip", "card", "phone")
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match never has to start inside a digit run: what fails at its start fails inside, too.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Characters that look like an ASCII one and have no compatibility form.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "һ": "h", "ԛ": "q", "ԝ": "w", "ь": "b", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "α": "a", "ο": "o", "ν": "v", "ι": "i",
    "κ": "k", "ρ": "p", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a", "․": ".", "。": ".", "‐": "-", "‑": "-",
    "‒": "-", "–": "-", "—": "-", "−": "-",
}
#: Characters without width.
INVISIBLE = frozenset("­͏؜᠎​‌‍⁠⁡⁢⁣⁤﻿")
#: Spelled digits.
DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
          "seven": "7", "eight": "8", "nine": "9"}

_NUMBER = "(?:" + "|".join(DIGITS) + ")"
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
#: A run of blanks is entered at its start only, so no blank is looked at twice.
_BLANKS = r"(?:(?<!\s)\s+)"
_DOT = rf"(?:{_BLANKS}?{_OPEN}\s*dot\s*{_CLOSE}\s*|{_BLANKS}dot\s+)"
#: Last labels that make a plainly spelled "at ... dot ..." an address and not prose.
LABELS = "com|org|net|edu|gov|info|biz|io|co|eu|de|fr|es|it|nl|ch|at|uk|us|ca|au|jp|in|br|ru|cn"
#: First labels of domains that "at" leads to in an address rather than in prose.
PROVIDERS = "[a-z0-9-]*mail[a-z0-9-]*|yahoo|outlook|live|msn|icloud|aol|gmx|proton|yandex|qq|example"
#: Words of prose that no host is called by.
PROSE = "that|this|these|those|the|an?|it|its|his|her|my|your|our|their|one|each|every|any|some|which|what|no"
#: Other last labels count where the phrase ends behind them ("... at ... dot dev.") and its host is no word of prose.
_HOST = rf"[a-z0-9-]+(?:{_DOT}[a-z0-9-]+)*?{_DOT}"
_SPELLED = rf"{_HOST}(?:{LABELS})\b|(?!(?:{PROSE})\b){_HOST}[a-z]{{2,24}}(?=[.,;:!?)\]>\"']|\s*\Z|[^\S\n]*\n)"
_HALF_SPELLED = rf"(?:{PROVIDERS})(?:\.[a-z0-9-]+)+\b"
REWRITES = re.compile(
    rf"(?P<at>{_BLANKS}?{_OPEN}\s*at\s*{_CLOSE}\s*|(?<=[a-z0-9])\s+at\s+(?={_SPELLED}|{_HALF_SPELLED}))"
    rf"|(?P<dot>{_DOT})"
    rf"|(?P<digits>\b(?:plus\s+)?{_NUMBER}(?:(?:\s|[,-]\s?){_NUMBER}){{2,}}\b|\b{_NUMBER}(?={_DOT})|(?<=dot )(?:{_NUMBER})\b)",
    re.IGNORECASE)
TRIGGER = re.compile(
    rf"\bdot\b|\bat\s+(?:{PROVIDERS})\.|{_OPEN}\s*(?:at|dot)\s*{_CLOSE}|\b{_NUMBER}(?:(?:\s|[,-]\s?){_NUMBER}){{2}}", re.IGNORECASE)
_WORD = re.compile(rf"plus|{_NUMBER}", re.IGNORECASE)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """One step per sign: the run of local characters before it, then the longest domain after it."""
    out, free, sign = [], 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, sign + 1) if start < sign else None
        free = m.end() if m else sign + 1
        if m:
            out.append((start, free))
        sign = text.find("@", free)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def identifiers(text: str, digits: bool = True) -> dict[str, list[tuple[int, int]]]:
    """Plain spans by kind; ``digits`` False: the text is known to hold none."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if digits:
        if "." in text:
            found["ip"] = [m.span() for m in IP.finditer(text) if all(map(_small, m.group().split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                d = _digits(m.group())
                if 14 <= len(d) <= 19 and _luhn(d):
                    found["card"].append(m.span())
        if "+" in text:
            found["phone"] = [m.span() for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return found


class Rewritten:
    """A text and, for each of its characters, the source span and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.new = np.zeros(len(text), bool)

    def replace(self, spans: list[tuple[int, int, str]]) -> None:
        """Replace disjoint, ascending spans; every written character stands for the whole span."""
        text, start, end, new, at = [], [], [], [], 0
        for a, b, s in [*spans, (len(self.text), len(self.text), "")]:
            text += [self.text[at:a], s]
            start += [self.start[at:a], np.full(len(s), self.start[a] if s else 0)]
            end += [self.end[at:a], np.full(len(s), self.end[b - 1] if s else 0)]
            new += [self.new[at:a], np.ones(len(s), bool)]
            at = b
        self.text = "".join(text)
        self.start, self.end, self.new = (np.concatenate(x) for x in (start, end, new))


def _plain(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    wide = unicodedata.normalize("NFKC", c)
    if len(wide) == 1 and wide.isascii():
        return wide
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.digit(c))
    return c


def look_alikes(text: str) -> list[tuple[int, int, str]]:
    made = {c: _plain(c) for c in set(text) if not c.isascii()}
    return [(i, i + 1, made[c]) for i, c in enumerate(text) if not c.isascii() and made[c] != c]


def _signs(m: re.Match) -> str:
    if m.lastgroup != "digits":
        return {"at": "@", "dot": "."}[m.lastgroup]
    return "".join(DIGITS.get(w.lower(), "+") for w in _WORD.findall(m.group()))


def disguised(text: str, base: dict[str, list[tuple[int, int]]], strange: bool) -> list[tuple[int, str]]:
    """(start, kind, end) of identifiers that only the rewritten text shows."""
    r = Rewritten(text)
    if strange:
        r.replace(look_alikes(text))
    if TRIGGER.search(r.text):
        r.replace([(m.start(), m.end(), _signs(m)) for m in REWRITES.finditer(r.text)])
    if not r.new.any():
        return []
    out = []
    for kind, spans in identifiers(r.text).items():
        taken = base[kind]                                      # disjoint and ascending
        starts = [x for x, _ in taken]
        for a, b in spans:
            if r.new[a:b].any():
                s, e = int(r.start[a]), int(r.end[b - 1])
                near = bisect_right(starts, s) - 1
                if near < 0 or taken[near][1] < e:
                    out.append((s, kind, e))
    return out


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _found(part, data, offs):
    """(text, base spans, all spans) of each row; a span is (start, kind number, end)."""
    points = np.concatenate([[0], np.cumsum((data >= 48) & (data < 58))])
    digits = points[offs[1:]] > points[offs[:-1]]
    beyond = np.concatenate([[0], np.cumsum((data >= 0xC4) | (data == 0xC2))])
    strange = beyond[offs[1:]] > beyond[offs[:-1]]
    for text, has, odd in zip(part.column("text").to_pylist(), digits.tolist(), strange.tolist()):
        base = identifiers(text, has)
        plain = [(a, k, b) for k, kind in enumerate(KINDS) for a, b in base[kind]]
        more = disguised(text, base, odd) if odd or TRIGGER.search(text) else []
        yield text, base, plain, plain + [(a, KINDS.index(kind), b) for a, kind, b in more]


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (plain ones), base_sha256, spans and n_disguised of every row."""
    def run(batches):
        for part, data, offs in scan.blocks(batches):
            counts, digest, listed, added = [], [], [], []
            for _, base, plain, every in _found(part, data, offs):
                counts.append([len(base[k]) for k in KINDS])
                digest.append(hashlib.sha256(_listed(plain).encode()).hexdigest())
                listed.append(_listed(every))
                added.append(len(every) - len(plain))
            counts = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(counts[:, k]) for k in range(len(KINDS))],
                 pa.array(digest), pa.array(listed), pa.array(added, pa.int64())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_disguised"])

    numbers = ", ".join(f"n_{k} long" for k in KINDS)
    return documents(docs).mapInArrow(
        run, f"doc_id {column_type(docs, 'doc_id')}, {numbers}, base_sha256 string, spans string, n_disguised long")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span replaced by its kind's mask; overlapping spans become one of the earlier kind."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], MASKS[KINDS[k]]]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the identifiers in ``text`` masked (null stays null) and n_chars, if there, brought up to date."""
    names = docs.columns
    inner = docs.select(*[F.col(c).alias(f"in{i}") for i, c in enumerate(names)], empty_text(docs["text"]).alias("text"))
    kinds = ", ".join(f"in{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))

    def run(batches):
        for part, data, offs in scan.blocks(batches):
            made = [masked(text, every) for text, _, _, every in _found(part, data, offs)]
            yield pa.RecordBatch.from_arrays([*part.columns[:len(names)], pa.array(made, pa.string())],
                                             [*part.schema.names[:len(names)], "text"])

    out = inner.mapInArrow(run, f"{kinds}, text string")
    fresh = {c: F.col(f"in{i}") for i, c in enumerate(names)}
    was = fresh["text"]
    fresh["text"] = F.when(was.isNotNull(), F.col("text"))
    if "n_chars" in fresh:
        fresh["n_chars"] = F.when(was.isNotNull() & (was != F.col("text")), F.length("text")).otherwise(
            fresh["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return out.select(*[fresh[c].alias(c) for c in names])
