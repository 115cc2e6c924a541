"""Find personal data by anchors: Aho-Corasick finds them, local parsers set and check the bounds.

Anchors are at-signs, plus signs, digits, scheme marks and identifier cues. A parser expands from
its anchor and checks what it found (octets, Luhn sums, digit counts, IBAN remainders). A parser
reads a stretch of text once: it never starts within a match of its own kind, and never twice in
one run of digits. The four base kinds equal their patterns applied leftmost and without overlap.

Rows: a null or empty text has no span; repeated rows are handled one by one; a null ``doc_id``
stays null; empty input gives empty output; columns besides ``doc_id`` and ``text`` are ignored.
Offsets are code points, ends exclusive.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from fareflow.llm.texts import pieces

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = 4

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ADDRESS = re.compile(r"[A-Za-z0-9._~%:@\[\]-]*[A-Za-z0-9\]](?:[/?#][^\s\"'<>]*)?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
SOCIAL = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])")
ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,16}(?![0-9])")
LEAD = re.compile(r"(?:\x20?(?:no|number|nr|num))?[\x20.:#=]{0,4}", re.IGNORECASE)
SCHEMES = ("http", "https", "ftp", "sftp", "ssh", "git", "ldap", "jdbc", "s3")
CUES = {"iban": IBAN, "ssn": SOCIAL, "social security": SOCIAL, "account": ACCOUNT, "acct": ACCOUNT, "konto": ACCOUNT}


@cache
def anchors() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    machine.add_word("@", "@")
    machine.add_word("+", "+")
    machine.add_word("://", "://")
    for digit in sorted(DIGITS):
        machine.add_word(digit, "0")
    for cue in CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            machine.add_word(form, cue)
    machine.make_automaton()
    return machine


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def iban_holds(text: str) -> bool:
    """Remainder 1 modulo 97 with letters as numbers, the first four characters last."""
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def longest_iban(text: str, start: int) -> int:
    """End of the longest stretch that is a valid IBAN, or 0."""
    found = IBAN.match(text, start)
    end = found.end() if found else 0
    while end - start >= 15:
        if text[end - 1] != " " and iban_holds(text[start:end]):
            return end
        end -= 1
    return 0


def find(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind number, end), sorted."""
    spans: list[tuple[int, int, int]] = []
    after = [0] * len(KINDS)
    email, ip, card, phone, url, account = range(len(KINDS))
    for last, anchor in anchors().iter(text):
        if anchor == "0":
            if last >= after[card]:
                found = CARD.match(text, last)
                if found:
                    after[card] = found.end()
                    digits = digits_of(found[0])
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        spans.append((last, card, found.end()))
            if last >= after[ip] and (not last or text[last - 1] not in DIGITS):
                found = IP.match(text, last)
                if found:
                    after[ip] = found.end()
                    if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in found[0].split("."))):
                        spans.append((last, ip, found.end()))
        elif anchor == "@":
            start = last
            while start > after[email] and text[start - 1] in LOCAL:
                start -= 1
            found = DOMAIN.match(text, last + 1) if start < last else None
            if found:
                after[email] = found.end()
                spans.append((start, email, found.end()))
        elif anchor == "+":
            found = PHONE.match(text, last) if last >= after[phone] else None
            if found:
                after[phone] = found.end()
                if 9 <= len(digits_of(found[0])) <= 15:
                    spans.append((last, phone, found.end()))
        elif anchor == "://":
            colon = last - 2
            if colon < after[url]:
                continue
            scheme = max((s for s in SCHEMES if text[max(0, colon - len(s)) : colon].lower() == s), key=len, default="")
            found = ADDRESS.match(text, last + 1) if scheme else None
            if found:
                end = last + 1 + len(found[0].rstrip(".,;:!?)"))
                after[url] = end
                spans.append((colon - len(scheme), url, end))
        else:
            start = LEAD.match(text, last + 1).end()
            if start < after[account]:
                continue
            if CUES[anchor] is IBAN:
                end = longest_iban(text, start)
            else:
                found = CUES[anchor].match(text, start)
                end = found.end() if found else 0
            if end:
                after[account] = end
                spans.append((start, account, end))
    return sorted(spans)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


FOUND = (
    "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
)


def find_private(docs: DataFrame) -> DataFrame:
    """Per document the counts of each kind, the digest of the base spans, and all spans."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            spans = [find(t) if t else [] for t in part.column("text").to_pylist()]
            counts = [pa.array([sum(s[1] == k for s in x) for x in spans], pa.int64()) for k in range(len(KINDS))]
            base = [hashlib.sha256(written([s for s in x if s[1] < BASE]).encode()).hexdigest() for x in spans]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), *counts, pa.array(base, pa.string()), pa.array(map(written, spans), pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(found, FOUND)
