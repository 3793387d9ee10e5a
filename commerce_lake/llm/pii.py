"""Personal data by anchor expansion.

An Aho-Corasick automaton runs once over a text, A-Z folded, and reports anchors:
at-signs, plus signs, digits, URL schemes and identifier cues. Around each anchor a local
parser expands to the boundaries of its kind and validates them. Parsers of one
kind move left to right and never look behind the end of their last match, so
matches are leftmost and do not overlap, and the work is linear in the text.

Kinds: email, ip, card (Luhn), phone; url (scheme with a host, which may hold
user data) and account (an identifier after a cue; IBANs are checked mod 97).

Defined results: null and empty texts have no spans; repeated rows each get
their own result; columns besides the key and text are not read. Offsets are
code points, end exclusive.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from commerce_lake.llm.common import with_text_columns

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SPANS = "array<struct<kind:string,start:int,end:int>>"

# The cues and schemes that serve as anchors.
CUES = ("account", "acct", "iban", "konto", "cuenta", "compte")
SCHEMES = ("http://", "https://", "ftp://", "ftps://")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\x00-\x20\"'<>\\^`{|}]+")
_ACCOUNT = re.compile(r"[\x20:#.=-]{1,4}(?:(?i:no|nr|number|num)[\x20:#.=]{1,3})?([A-Za-z]{0,4}[0-9](?:[\x20-]?[A-Za-z0-9]){5,33})")


def folded(text: str) -> str:
    """The text with A-Z in lower case, of the same length."""
    return text.encode().lower().decode()  # of bytes: folds ASCII only


def automaton() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    anchors.add_word("@", ("@", 1))
    anchors.add_word("+", ("+", 1))
    for digit in "0123456789":
        anchors.add_word(digit, ("0", 1))
    for scheme in SCHEMES:
        anchors.add_word(scheme, ("url", len(scheme)))
    for cue in CUES:
        anchors.add_word(cue, ("cue", len(cue)))
    anchors.make_automaton()
    return anchors


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    total += sum(divmod(2 * int(d), 10)[0] + divmod(2 * int(d), 10)[1] for d in digits[-2::-2])
    return total % 10 == 0


def iban(text: str) -> bool:
    """Whether the check digits of an IBAN hold."""
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _account(text: str, at: int) -> tuple[int, int] | None:
    """The identifier after a cue that ends at `at`, if it is one."""
    found = _ACCOUNT.match(text, at)
    if not found:
        return None
    start, end = found.span(1)
    groups = re.split(r"[\x20-]", text[start:end])
    while groups and not any(c.isdigit() for c in groups[-1]):  # a following word is no part of it
        end -= len(groups.pop()) + 1
    plain = "".join(groups)
    if re.fullmatch(r"[A-Za-z]{2}[0-9]{2}[A-Za-z0-9]{11,30}", plain):
        return (start, end) if iban(plain) else None
    return (start, end) if 6 <= sum(c.isdigit() for c in plain) else None


def spans_of(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind as listed, then start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    free = dict.fromkeys((*KINDS, "dotted"), 0)  # where the next match of a kind may begin
    for last, (anchor, length) in anchors.iter(folded(text)):
        at = last - length + 1
        if anchor == "0":
            if at >= free["dotted"]:
                chain = _DOTTED.match(text, at)
                free["dotted"] = chain.end()
                parts = [m.span() for m in re.finditer("[0-9]+", chain[0])] if "." in chain[0] else []
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k : k + 4]
                    if all(b - a <= 3 or not chain[0][a : b - 3].strip("0") for a, b in four) and all(
                        int(chain[0][max(a, b - 3) : b]) <= 255 for a, b in four
                    ):
                        found["ip"].append((at + four[0][0], at + four[3][1]))
            if at >= free["card"] and (chain := _DIGITS.match(text, at)):
                free["card"] = chain.end()
                digits = chain[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(chain.span())
        elif anchor == "@":
            start = at
            while start > free["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (domain := _DOMAIN.match(text, at + 1)):
                free["email"] = domain.end()
                found["email"].append((start, domain.end()))
        elif anchor == "+":
            if at >= free["phone"] and (number := _PHONE.match(text, at)):
                free["phone"] = number.end()
                if 8 <= sum(c.isdigit() for c in number[0]) <= 15:
                    found["phone"].append(number.span())
        elif anchor == "url":
            if at >= free["url"] and (rest := _URL.match(text, last + 1)):
                end = last + 1 + len(rest[0].rstrip(".,;:!?)]"))
                if end > last + 1 and text[last + 1].isalnum():
                    free["url"] = end
                    found["url"].append((at, end))
        elif at >= free["account"] and (span := _account(text, last + 1)):
            free["account"] = span[1]
            found["account"].append(span)
    return [(kind, *span) for kind in KINDS for span in found[kind]]


def find(documents: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Every row with its spans in place of its text."""

    def make():
        anchors = automaton()
        return lambda texts: [
            [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t, anchors)] for t in texts]
        ]

    return with_text_columns(documents, text, make, f"{spans} {SPANS}", drop_text=True)
