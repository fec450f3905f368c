"""Secret scans: fixed patterns, and strings that zstandard cannot compress against code it has just seen.

Base kinds are patterns. The method adds `novel` spans: a candidate is a long unbroken string with a sensitive word in
the text before it, on whatever line, or in its own name; a value goes on over strings with no word between them, as in
a block of base64 lines. A dictionary primed with common identifiers and the text around the candidate compresses it,
long ones in pieces; the marginal bytes are what the candidate adds to the compressed context. Ordinary names, paths and
strings that the text shows outside a sensitive context add little; random strings add almost their entropy and are
reported, with all their copies in the text. Strings of words and numbers, such as paths, file names and dates, and UUIDs
are not candidates.

Null and empty texts have no spans. Repeated rows give a row each. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from math import log2

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import PACKED, packed, per_text

KINDS = ("assign", "access", "hex", "novel")
#: Characters on each side that count as surrounding code.
AROUND = 256
#: Most characters that are compressed at once: from about 64 on the literals are entropy-coded, and long random strings
#: would come near 1 bit a bit of their alphabet.
PIECE = 48
#: Marginal compressed bits per bit of the alphabet from which a candidate counts as incompressible after the ordinary
#: text around it: names and paths are mostly below.
NOVELTY = 1.15
#: The same after the other candidates around it too. Beside other random strings a random one gives about 0.85 to 1,
#: since they pay for the code of its literals; a name beside its like gives far less.
NOVELTY_AMONG = 0.8
MIN_LENGTH = 16

#: The base patterns. `+` stands where failing matches must still use up their text.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Words that make what follows them sensitive, whole or as a part of a name: `auth` in auth_code and userAuth, not in
#: author. Fixed values.
_NAMES = (
    "pass(?:w(?:or)?ds?|wd|phrases?|code)|secrets?|tokens?|api.?keys?|access.?keys?|private.?keys?|secret.?keys?|credentials?|"
    "auth(?:orization|entication|enticat(?:e|or)|z|n)?|bearer|signatures?|session(?:.?(?:id|key|token))?|salt|signing|webhooks?|"
    "connection.?strings?|pwd"
)
SENSITIVE = re.compile(
    rf"(?<![A-Za-z])(?i:{_NAMES})(?![a-z])|(?<=[a-z])(?=[A-Z])(?i:{_NAMES})(?![a-z])", re.ASCII
)
_SENSITIVE_WORDS = (
    b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"auth", b"bearer", b"signature", b"session",
    b"salt", b"signing", b"webhook", b"connection",
)
#: No plain word: a digit, or small and capital letters in turns.
_MIXED = re.compile(r"[0-9]|[a-z][A-Z]+[^A-Z]+[A-Z]")
#: Names made of words and numbers, such as file names, versions, paths and hosts, and ids of a common form: dates and
#: times, and the five groups of a UUID.
_PART = (
    r"(?>(?:[A-Za-z]?[a-z]{0,30}[0-9]{0,4}|[A-Z]{1,30}[0-9]{0,4}|[0-9]{1,3}[A-Za-z]{0,3}|[0-9]{1,14}|[0-9]{4,8}T[0-9]{4,6}Z?)"
    r"(?![A-Za-z0-9]))"
)
_ORDINARY = re.compile(rf"{_PART}(?:[+/_=.~-]++{_PART})*+")
_UUID = re.compile("[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Words at the start of a candidate that name the rest of it.
_NAME = re.compile(r"(?:[A-Za-z]+[+/_.~-])+")
#: A word: what stands between two strings of one value has none.
_WORD = re.compile("[A-Za-z0-9]{2}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{%d,}" % MIN_LENGTH)

#: Identifiers and code that the dictionary is primed with.
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key private_key client_secret credential authorization bearer "
    "signature session_id certificate username user_name email address example placeholder your_password_here changeme "
    "localhost default database connection configuration application environment variable production development "
    "import from return function class public private static final void string integer boolean true false null none "
    "self this new delete const let var def async await yield lambda raise throw catch except finally while for if "
    "else elif switch case break continue https:// http:// www. .com .org .net .json .yaml .html .properties "
    "/usr/local/bin /etc/ssl/certs /home/user/ /var/lib/ node_modules src/main/java com.example org.apache "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 "
    "the of and to in that is was for with as on by this are be from or not have which one "
)


def base_spans(text: str, lowered: bytes) -> list[tuple[int, int, str]]:
    """The spans of the base patterns; `lowered` is the text as lower-cased UTF-8."""
    spans = []
    if any(word in lowered for word in _ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"akia" in lowered:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return spans


def compressor(identifiers: str = IDENTIFIERS) -> Callable[[str, str], int]:
    """A function of a context and a candidate: the bytes the candidate adds to the compressed context."""
    primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    made = zstandard.ZstdCompressor(
        level=9, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False
    )

    @lru_cache(maxsize=16)
    def alone(before: bytes) -> int:
        return len(made.compress(before))

    def marginal(context: str, candidate: str) -> int:
        before = context.encode()
        return len(made.compress(before + candidate.encode())) - alone(before)

    return marginal


def _alphabet_bits(text: str) -> float:
    """Bits that one random character of this candidate's kind carries."""
    kinds = (str.isdigit, 10), (str.islower, 26), (str.isupper, 26)
    size = sum(n for test, n in kinds if any(map(test, text)))
    return log2(max(2, 16 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text) else size))


def _value_start(text: str, start: int, end: int) -> int:
    """Where the value begins in a run: after the last '=' that is no padding, if that leaves a long string."""
    cut = text.rfind("=", start, start + len(text[start:end].rstrip("="))) + 1
    return cut if cut and end - cut >= MIN_LENGTH else start


def _sensitive_values(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The values that a sensitive word, or a string of the same value, precedes."""
    out = []
    for run, end in runs:
        start = _value_start(text, run, end)
        name = _NAME.match(text, start, end)
        if (
            SENSITIVE.search(text, max(0, min(run, start - AROUND)), name.end() if name else start)
            or out and not _WORD.search(text, out[-1][1], start)
        ):
            out.append((start, end))
    return out


def _without(text: str, start: int, end: int, spans: list[tuple[int, int]]) -> str:
    """text[start:end] without the characters of the spans, which are in order."""
    out = []
    for a, b in spans:
        if b > start and a < end:
            out.append(text[start:a] if a > start else "")
            start = max(start, b)
    return "".join([*out, text[start:end]])


def _is_ordinary(value: str) -> bool:
    """Whether a value is put together from words and numbers, or is a UUID, however often one has such a form."""
    return bool(_ORDINARY.fullmatch(value) or _UUID.search(value) and _ORDINARY.fullmatch(_UUID.sub("0", value)))


def _own_copies(text: str, found: str, start: int, end: int) -> list[tuple[int, int]]:
    """The copies of `found` in text[start:end]: a secret is one, wherever else it stands."""
    out, at = [], text.find(found, start, end)
    while at >= 0:
        out.append((at, at + len(found)))
        at = text.find(found, at + len(found), end)
    return out


def _merged(*spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return sorted(span for some in spans for span in some)


def _is_novel(text: str, k: int, values: list[tuple[int, int]], marginal: Callable[[str, str], int]) -> bool:
    """Whether the k-th value is incompressible, after the text around it and after the other values there."""
    (start, end), first, last = values[k], k, k + 1
    low, high = max(0, start - AROUND), end + AROUND
    while first and values[first - 1][1] > low:
        first -= 1
    while last < len(values) and values[last][0] < high:
        last += 1
    found, near = text[start:end], values[first:last]
    n = -(-len(found) // PIECE)
    pieces = [found[len(found) * i // n : len(found) * (i + 1) // n] for i in range(n)]
    bits = len(found) * _alphabet_bits(found) / 8
    # also those that the edge of the context cuts
    copies_before = _own_copies(text, found, max(0, low - len(found)), start)
    copies_after = _own_copies(text, found, end, high + len(found))
    before = _without(text, low, start, _merged(near, copies_before))
    after = _without(text, end, high, _merged(near, copies_after))
    # one context may happen to take the string up well
    contexts = {before + after, before, after}
    if sum(max(marginal(c, piece) for c in contexts) for piece in pieces) < NOVELTY * bits:
        return False
    before, after = _without(text, low, start, copies_before), _without(text, end, high, copies_after)
    contexts = {before + after, after + before}
    return sum(max(marginal(c, piece) for c in contexts) for piece in pieces) >= NOVELTY_AMONG * bits


def _copies(text: str, runs: list[tuple[int, int]], found: set[str]) -> list[tuple[int, int]]:
    """Where the strings `found` stand in the runs, the longest at each place."""
    by_start: dict[str, list[str]] = {}
    for value in sorted(found, key=lambda v: -len(v)):
        by_start.setdefault(value[:MIN_LENGTH], []).append(value)
    out = []
    for at, end in runs:
        while at + MIN_LENGTH <= end:
            known = by_start.get(text[at : at + MIN_LENGTH], ())
            size = next((len(v) for v in known if at + len(v) <= end and text.startswith(v, at)), 0)
            if size:
                out.append((at, at + size))
            at += size or 1
    return out


def novel_spans(text: str, lowered: bytes, marginal: Callable[[str, str], int]) -> list[tuple[int, int, str]]:
    """Candidates in a sensitive context whose marginal bytes show them to be incompressible, and their copies."""
    if not any(word in lowered for word in _SENSITIVE_WORDS):
        return []
    runs = [m.span() for m in _CANDIDATE.finditer(text)]
    values = _sensitive_values(text, runs)
    found = {
        text[start:end]
        for k, (start, end) in enumerate(values)
        if _MIXED.search(text, start, end) and not _is_ordinary(text[start:end]) and _is_novel(text, k, values, marginal)
    }
    return [(start, end, "novel") for start, end in _copies(text, runs, found)] if found else []


def scan_text(raw: bytes, marginal: Callable[[str, str], int]) -> list[tuple[int, int, str]]:
    """All spans of a text, by start, then kind, then end."""
    text, lowered = raw.decode("utf-8", "replace"), raw.lower()
    spans = base_spans(text, lowered) + novel_spans(text, lowered, marginal)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan_secrets(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", identifiers: str = IDENTIFIERS
) -> DataFrame:
    """`keep` and spans, an array of (start, stop, kind), of each whole text."""

    def factory():
        marginal = compressor(identifiers)
        return lambda raw: (scan_text(raw, marginal),)

    return per_text(docs, factory, "spans array<struct<start:long,stop:long,kind:string>>", keep, text)


def masked(raw: bytes, spans: list[tuple[int, int, str]], mask: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones together, replaced by `mask`."""
    text, out, at = raw.decode("utf-8", "replace"), [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text: str = "text", identifiers: str = IDENTIFIERS) -> DataFrame:
    """The same rows and columns with all secrets masked; n_chars, if there is one, follows a changed text. A null
    text stays null."""

    def factory():
        marginal = compressor(identifiers)

        def change(raw: bytes) -> tuple:
            spans = scan_text(raw, marginal)
            return (masked(raw, spans) if spans else None,)

        return change

    rows = per_text(packed(docs, text), factory, "_masked string", PACKED, "_text")
    out = {c: F.col("_text") if c == text else F.col("_doc")[c] for c in docs.columns}
    out[text] = F.coalesce("_masked", out[text])
    if "n_chars" in out:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("_masked").isNotNull(), F.length("_masked").cast(kind)).otherwise(out["n_chars"])
    return rows.select(*[column.alias(name) for name, column in out.items()])
