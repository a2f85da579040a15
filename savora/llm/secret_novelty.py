"""Secret scans: patterns, and zstandard novelty of strings in sensitive places.

A candidate is a value behind a sensitive word (``auth``, ``credential``, ``private key`` ...).  Its marginal
size is what it adds to the compressed size when zstandard is primed with a dictionary of
the identifiers of common code and the text around the candidate.  Words, names and values that
the surroundings repeat cost next to nothing; a random string costs about its entropy.  Candidates that stay near
their own length are reported.  Without a digit, where unknown words stay near it too, a candidate must also have letters that
follow one another as they do not in words: ``letter_bits`` a pair on average, by a table of pairs of ordinary words.

Spans are code points, end exclusive.  Defined cases: a null text is an empty text and has no spans; repeated rows are
scanned alike; other columns pass through; a text of any length is scanned whole, one text at a time.
"""

from __future__ import annotations

import re
from typing import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from savora.llm.common import tidy

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(
    r"""(?:auth(?:orization)?|bearer|credentials?|private[ _-]?key|access[ _-]?key|signature|pwd|passphrase|passcode"""
    r"""|client[ _-]?id|session[ _-]?id|cookie|password|passwd|secret|token|api[ _-]?key)["']?\x20*(?:[:=]|\x20is\x20|=>)?\x20*["']?([A-Za-z0-9+/_.=~$!@%^&*-]{12,})""", re.I | re.A)
# lower-case pieces of which a text must hold one before the patterns are worth trying
ASSIGN_HINTS = ("passw", "secret", "token", "api")
SENSITIVE_HINTS = ("auth", "bearer", "credential", "key", "signature", "pwd", "pass", "client", "session", "cookie", "secret", "token")

IDENTIFIERS = (
    "import from return class def self none true false public static void final string int const let var function async await "
    "new this null undefined export default require module include define struct package private protected interface "
    "config settings environment example placeholder changeme your_token_here your_api_key_here xxxxxxxxxxxxxxxx "
    "password passwd secret token api_key apikey access_key secret_key client_id client_secret authorization bearer "
    "get_token set_password request response headers content-type application/json username email localhost http https www com "
    "os.environ process.env getenv credentials private_key public_key session_id cookie signature the and of to in is for with that "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ").encode()
AROUND = 256
NOVELTY = 0.6

# bits of each letter (column) behind each letter (row), from 1 to 9, over 11,833 different words of English and Spanish technical prose
PAIR_BITS = (
    "94449759587343959343667868 35574989369277469446498959 39573894494478289563499979 37752778299587379556578979 57436668789453757334867579 "
    "49773479299478399465498969 48882854499564479347488988 28872798399667389474699969 46444559999452369544959795 28882887586888288858288878 "
    "57761657398485668636675969 38752899299478379855579949 25972899399658339856599969 48433638497786479842669989 76448769796442559345465799 "
    "39673896499398359354598959 79769799799777999767199999 38552769397656379544567969 49482785397678448842488969 38672794299678469345598959 "
    "44564669599443649333999989 29791999299999479899899999 39663874299684469446996799 47363796399658737662889658 56454567499543529533676976 "
    "29791989399868379986999966 ").split()
SYMBOL_BITS = 6
LETTER_BITS = 4.75

SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())]))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three patterns, by start, then kind as listed."""
    found = []
    lowered = text.lower()
    if any(h in lowered for h in ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # runs of hex digits are maximal, so asking for 24 drops the same matches as checking afterwards
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def novelty(value: str, before: str, after: str) -> float:
    """Marginal compressed bytes of ``value`` to its bytes, primed with what stands around it."""
    around = IDENTIFIERS + before.encode("utf-8", "replace") + b"\n" + after.encode("utf-8", "replace")
    primer = zstandard.ZstdCompressionDict(around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=3, dict_data=primer, write_checksum=False, write_content_size=False, write_dict_id=False)
    raw = value.encode("utf-8", "replace")
    return max(0, len(packer.compress(raw)) - len(packer.compress(b""))) / len(raw)


def letter_bits(value: str) -> float:
    """Mean bits of a letter behind the one before it, as ordinary words have them; small letters and capitals are one.

    Words may be joined by ``_ - . / =``; a pair with any other sign has ``SYMBOL_BITS``.
    """
    bits = [PAIR_BITS[ord(a) - 97][ord(b) - 97] if a.isalpha() and b.isalpha() else SYMBOL_BITS
            for run in re.split("[_./=-]", value.lower()) for a, b in zip(run, run[1:])]
    return sum(map(int, bits)) / len(bits) if bits else 0.0


def novel_spans(text: str, threshold: float = NOVELTY) -> list[tuple[str, int, int, float]]:
    """Values behind sensitive words that neither the dictionary nor the surroundings explain."""
    lowered = text.lower()
    if not any(h in lowered for h in SENSITIVE_HINTS):
        return []
    found = []
    for m in SENSITIVE.finditer(text):
        start, end = m.span(1)
        value = text[start:end]
        score = novelty(value, text[max(0, start - AROUND):start], text[end:end + AROUND])
        # zstandard finds repeats of three bytes and more; entropy coding of a short string
        # costs more than it gains, so words it has not seen look as novel as keys
        if score >= threshold and (any(c.isdigit() for c in value) or letter_bits(value) >= LETTER_BITS):
            found.append(("novel", start, end, score))
    return found


def scan_text(text: str, threshold: float = NOVELTY) -> list[dict]:
    spans = [(k, s, e, None) for k, s, e in base_spans(text)] + novel_spans(text, threshold)
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return [dict(zip(("kind", "start", "end", "novelty"), s)) for s in spans]


def scan(docs: DataFrame, text: str = "text", threshold: float = NOVELTY) -> DataFrame:
    """Add ``spans``, an array of ``(kind, start, end, novelty)``, to every row."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(part.schema.get_field_index(text))
            spans = pa.array([scan_text(v.as_py() or "", threshold) for v in texts], SPANS)
            kept = [i for i, n in enumerate(part.schema.names) if n != "spans"]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), spans], [*(part.schema.names[i] for i in kept), "spans"])
    shape = docs.drop("spans").withColumn("spans", F.lit(None).cast("array<struct<kind:string,start:bigint,end:bigint,novelty:double>>")).schema
    return docs.mapInArrow(tidy(batches), shape)


def redact(docs: DataFrame, text: str = "text", threshold: float = NOVELTY) -> DataFrame:
    """Replace every span in the text by ``[KIND]``; overlapping spans are replaced together."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            names = part.schema.names
            clean = pa.array([t and cut(t, scan_text(t, threshold)) for t in part.column(names.index(text)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([clean if n == text else part.column(i) for i, n in enumerate(names)], names)
    return docs.mapInArrow(tidy(batches), docs.schema)


def cut(text: str, spans: list[dict]) -> str:
    out, at = [], 0
    for span in spans:
        if span["start"] >= at:
            out += [text[at:span["start"]], f"[{span['kind'].upper()}]"]
        at = max(at, span["end"])
    return "".join(out) + text[at:]
