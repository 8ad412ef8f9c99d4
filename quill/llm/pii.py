"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors in a whole text: at-signs, plus
signs, digits, URL schemes, and cue words of identifiers and addresses. Every
anchor has a deterministic local parser that expands it to the left and right
and validates what it finds; text without anchors is never looked at again.

Base kinds (leftmost, non-overlapping within a kind, failing matches dropped):
``email``, ``ip`` (parts at most 255), ``card`` (14 to 19 digits, Luhn) and
``phone`` (10 to 15 digits after a plus sign). Added kinds, only where no span
lies already: ``url`` (scheme, host with a dot), ``secret`` (value after a cue
such as token or password), ``account`` (IBAN by its check digits, or a number
after a cue such as account or SSN) and ``address`` (house number and street).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import arrow

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "secret", "account", "address")

#: fixed cue words; matched in lower case, upper case and capitalised
SECRET_CUES = ("token", "password", "passwd", "secret", "api_key", "apikey", "api key", "access key", "bearer")
ACCOUNT_CUES = ("iban", "account", "acct", "ssn", "passport", "konto", "compte", "cuenta")
STREET_CUES = ("street", "avenue", "road", "lane", "boulevard", "straße", "strasse", "rue", "calle")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_RUN = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SCHEME = re.compile(r"(?:https?|ftp|wss?|sftp|ssh)\Z", re.I)
_URL_REST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{1,5})?(?:[/?#][^\s\"'<>]*)?")
_SECRET = re.compile(r"[\"']?\s{0,2}[:=]\s{0,2}[\"']?([A-Za-z0-9+/_.~-]{8,})")
_BEARER = re.compile(r"[\x20:=]{1,3}([A-Za-z0-9+/_.~-]{16,}=*)")
_ACCOUNT = re.compile(r"(?:[\x20.]{0,2}(?:no|nr|number|num|id)\.?)?[\x20:=#.]{1,4}([0-9](?:[\x20-]?[0-9]){5,})", re.I)
_IBAN = re.compile(r"[\x20:=#.]{1,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){10,30})")
_HOUSE = re.compile(r"[0-9]{1,5}[A-Za-z]?\x20(?:[A-Z][\w'-]*\x20){1,3}\Z")
_AFTER = re.compile(r"\x20[0-9]{1,5}[a-z]?\b")
_NAMED = re.compile(r"\x20(?:[A-Z][\w'-]*\x20){1,3}[0-9]{1,5}\b")
_NAME = re.compile(r"\x20(?:[dl][a-z']*\x20){0,2}[A-Z][\w'-]*")
_STEM = re.compile(r"[A-Z][a-zäöüß]+\Z")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def iban_holds(text: str) -> bool:
    """ISO 7064 mod 97 over the rearranged account number."""
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for kind, cues in (("secret", SECRET_CUES), ("account", ACCOUNT_CUES), ("street", STREET_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                a.add_word(form, (kind, len(form)))
    a.make_automaton()
    return a


def _added(text: str, kind: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Spans of the added kinds around a cue at ``text[start:end]``."""
    if kind == "scheme":
        left = _SCHEME.search(text[max(0, start - 5):start])
        rest = _URL_REST.match(text, end)
        if left and rest:
            return [("url", start - len(left.group()), rest.end())]
    elif kind == "secret":
        m = (_BEARER if text[start:end].lower() == "bearer" else _SECRET).match(text, end)
        if m and any(c.isdigit() for c in m.group(1)):
            return [("secret", *m.span(1))]
    elif kind == "account":
        m = _IBAN.match(text, end)
        found = m.group(1) if m else ""
        while " " in found and not iban_holds(found):   # the run may hold a following word
            found = found[:found.rindex(" ")]
        if found and iban_holds(found):
            return [("account", m.start(1), m.start(1) + len(found))]
        m = _ACCOUNT.match(text, end)
        if m and not text[max(0, start - 1):start].isalpha():
            return [("account", *m.span(1))]
    elif kind == "street":
        cue = text[start:end].lower()
        head = text[max(0, start - 80):start]
        if cue in ("straße", "strasse"):
            name, no = _STEM.search(head), _AFTER.match(text, end)
            if no and (name or text[start:end][0].isupper()):
                return [("address", start - (len(name.group()) if name else 0), no.end())]
        elif cue == "calle":
            m = _NAMED.match(text, end)
            if m:
                return [("address", start, m.end())]
        elif cue == "rue":
            no, name = re.search(r"[0-9]{1,5},?\x20\Z", head), _NAME.match(text, end)
            if no and name:
                return [("address", start - len(no.group()), name.end())]
        else:
            m = _HOUSE.search(head)
            if m and not text[end:end + 1].isalpha():
                return [("address", start - len(m.group()), end)]
    return []


def find(text: str | None, anchors) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` in code points, by start, then kind."""
    if not text:
        return []
    spans: list[tuple[str, int, int]] = []
    cues = []
    mail = ip = card = phone = 0        # where the next match of a kind may start
    for last, (kind, size) in anchors.iter(text):
        at = last + 1 - size
        if kind == "digit":
            if at >= card:
                m = _CARD.match(text, at)
                card = m.end() if m else at + 1
                if m:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        spans.append(("card", at, card))
            if at >= ip:
                m = _IP.match(text, at)
                ip = m.end() if m else _RUN.match(text, at).end()
                if m and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                    spans.append(("ip", at, ip))
        elif kind == "at":
            left = at
            while left > mail and text[left - 1] in _LOCAL:
                left -= 1
            m = _DOMAIN.match(text, last + 1) if left < at else None
            if m:
                mail = m.end()
                spans.append(("email", left, mail))
        elif kind == "plus":
            m = _PHONE.match(text, at) if at >= phone else None
            if m:
                phone = m.end()
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    spans.append(("phone", at, phone))
        else:
            cues.append((kind, at, last + 1))
    if cues:
        taken = sorted((s, e) for _, s, e in spans)
        for cue in cues:
            for kind, s, e in _added(text, *cue):
                k = bisect_right(taken, (s, e))
                if (k == 0 or max(x[1] for x in taken[max(0, k - 4):k]) <= s) and \
                        (k == len(taken) or taken[k][0] >= e):
                    taken.insert(k, (s, e))
                    spans.append((kind, s, e))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _found(batches):
    anchors = automaton()
    for b in batches:
        counts = {k: [] for k in BASE}
        sha, joined = [], []
        for text in b.column(1).to_pylist():
            spans = find(text, anchors)
            base = [x for x in spans if x[0] in BASE]
            for k in BASE:
                counts[k].append(sum(x[0] == k for x in base))
            sha.append(hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest())
            joined.append(",".join(f"{k}:{s}:{e}" for k, s, e in spans))
        yield pa.RecordBatch.from_arrays(
            [b.column(0)] + [pa.array(counts[k], pa.int64()) for k in BASE]
            + [pa.array(sha, pa.string()), pa.array(joined, pa.string())],
            ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of the base kinds, the SHA-256 of their
    spans and all spans as ``kind:start:end`` (code points, end exclusive).

    Null and empty texts have no span (empty string, hash of the empty
    string); a null id stays null; repeated rows give equal rows. Other
    columns are ignored, whatever their names.
    """
    return arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col)), _found,
                 "doc_id long, " + ", ".join(f"n_{k} long" for k in BASE)
                 + ", base_sha256 string, spans string")
