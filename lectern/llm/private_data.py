"""Personal data found by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers find the boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lectern.llm._words import slices

#: In the order of results: the base kinds, then those that the method adds.
KINDS = ("email", "ip", "card", "phone", "iban", "login_url", "secret")
BASE_KINDS = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"[0-9][\x20().0-9-]+[0-9]")
_USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+:[^\s/?#@]+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
_IBAN = re.compile(r"\x20?:?\x20?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_VALUE = re.compile(r"[\"']?\x20?[=:]\x20?[\"']?([A-Za-z0-9_+/.-]{8,})")
_KEY_ID = re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])")

#: Anchors and the parser that each starts. Identifier cues are met in any case of their letters.
CUES = {
    **{c: "secret" for c in ("password", "passwd", "token", "secret", "api_key", "apikey", "access_key", "auth_key")},
    "iban": "iban",
    "akia": "key_id",
    "://": "login_url",
    "@": "email",
    "+": "phone",
    **{d: "digits" for d in "0123456789"},
}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for cue, parser in CUES.items():
        found.add_word(cue, (len(cue), parser))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _is_octet(digits: str) -> bool:
    """Whether digits, any number of zeros in front, are 255 at most."""
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def _iban_holds(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _folded(text: str) -> str:
    """A-Z in lower case: unlike str.lower(), it keeps each code point's place."""
    return text.translate(_FOLD)


_FOLD = {c: c + 32 for c in range(65, 91)}


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """Spans (kind, start, end) of a text in code points, by kind as in KINDS, then by start.

    Each anchor is expanded to the boundaries of the base patterns, leftmost first and without overlap within a kind.
    """
    spans: list[tuple[int, int, int]] = []
    email_end = dotted_end = card_end = secret_end = url_end = iban_end = 0
    for last, (size, parser) in automaton.iter(_folded(text)):
        at = last + 1
        if parser == "digits":
            if last >= dotted_end:
                m = _NUMBERS.match(text, last)
                dotted_end, start = m.end(), last
                parts = m.group().split(".")
                for i in range(0, len(parts) - len(parts) % 4, 4):
                    end = start + sum(map(len, parts[i : i + 4])) + 3
                    if all(_is_octet(p) for p in parts[i : i + 4]):
                        spans.append((1, start, end))
                    start = end + 1
            if last >= card_end and (m := _CARD.match(text, last)):
                card_end = m.end()
                digits = re.sub(r"[\x20-]", "", m.group())
                if 16 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, last, m.end()))
        elif parser == "email":
            start = last
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (m := _DOMAIN.match(text, at)):
                email_end = m.end()
                spans.append((0, start, email_end))
        elif parser == "phone":
            if m := _PHONE.match(text, at):
                if 8 <= sum(c in _DIGITS for c in m.group()) <= 15:
                    spans.append((3, last, m.end()))
        elif parser == "login_url":
            start = last - size + 1
            while start > url_end and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "+.-"):
                start -= 1
            if start < last - size + 1 and (m := _USERINFO.match(text, at)):
                url_end = m.end()
                spans.append((5, start, url_end))
        elif parser == "iban":
            if at >= iban_end and (m := _IBAN.match(text, at)):
                code, end = m.group(1), m.end()
                while len(code.replace(" ", "")) >= 15:  # the longest that holds; 30 tries at most
                    if _iban_holds(code.replace(" ", "")):
                        iban_end = end
                        spans.append((4, m.start(1), end))
                        break
                    end -= 1
                    code = text[m.start(1) : end].rstrip()
                    end = m.start(1) + len(code)
        elif parser == "secret":
            m = _VALUE.match(text, at)
            if m and m.start(1) >= secret_end and any(c in _DIGITS for c in m.group(1)):
                secret_end = m.end(1)
                spans.append((6, m.start(1), secret_end))
        elif parser == "key_id":
            start = last - size + 1
            before = text[start - 1] if start else " "
            if text[start:at] == "AKIA" and not before.isalnum() and start >= secret_end and (m := _KEY_ID.match(text, at)):
                secret_end = m.end()
                spans.append((6, start, secret_end))
    return sorted(spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_private_data(docs: DataFrame, with_redacted: bool = False) -> DataFrame:
    """Spans of personal data; per row: doc_id, a count of each base kind, base_sha256, spans.

    spans lists kind:start:end, comma-joined, by kind (email, ip, card, phone, iban, login_url, secret), then start, in
    code points, end exclusive; base_sha256 hashes the same of the first four kinds. with_redacted adds the text with
    each span, or union of spans that overlap, replaced by its first kind in brackets. A null text is empty. Rows are
    judged one by one, so repeated rows give equal results; other columns are ignored. No shuffle.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        automaton = _automaton()
        for batch in slices(batches):
            counts = np.zeros((batch.num_rows, len(KINDS)), np.int64)
            sha, listed, redacted = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = find_spans(text or "", automaton)
                for kind, _, _ in found:
                    counts[i, kind] += 1
                joined = [f"{KINDS[k]}:{a}:{b}" for k, a, b in found]
                sha.append(hashlib.sha256(",".join(joined[: counts[i, :4].sum()]).encode()).hexdigest())
                listed.append(",".join(joined))
                if with_redacted:
                    redacted.append(redact(text, found))
            cols = [batch.column("doc_id"), *(pa.array(counts[:, k]) for k in range(4)), pa.array(sha), pa.array(listed)]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            if with_redacted:
                cols, names = [*cols, pa.array(redacted, pa.string())], [*names, "redacted"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA + ", redacted string" * with_redacted)


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """text with the spans replaced; overlapping spans become one, named for the one that starts first."""
    if not text or not spans:
        return text
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind]}]"]
        done = max(done, b)
    return "".join(out) + text[done:]
