"""Operator 3: personal data by anchor expansion.

One Aho-Corasick pass over a whole text finds anchors: at-signs, ``+`` before a
digit, digits, schemes and identifier cues.  At each anchor a small deterministic
parser expands to the left and right and validates what it found.  Text without
anchors costs the automaton pass only, and every parser moves forward, so a text
is read a bounded number of times however long it is.

Kinds, in their order: email, ip, card, phone (the contract's base kinds, leftmost
and non-overlapping within a kind; a match that fails its check is dropped
without a retry), then
  account  IBANs of their country's length that pass mod 97, and numbers of 6 or more digits after an
           account cue ("account", "konto", "compte", "cuenta" ...),
  address  house number, capitalised words and a street word, or a leading street
           word, capitalised words and a house number,
  login    URLs with user information before the host,
  secret   values after "token", "password", "api_key" and the like and a ``:`` or ``=``, the name in
           quotes or not: quoted ones of 6 characters or more, bare ones of 16 or more, after
           a password cue of 6 or more with a letter and a digit; and bearer tokens of 16 or more.

Defined results: a null text is an empty one and has no spans; repeated rows get
equal results; an empty table gives an empty result; extra columns are ignored by
``find_spans`` and kept by ``mask_documents``.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import bounded_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("account", "address", "login", "secret")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_LETTER = re.compile(r"[A-Za-z]")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_ACCOUNT = re.compile(r"(?:\x20{0,2}(?:number|no|nr|num|id)\b\.?)?[\x20:#=.]{1,4}([0-9](?:[\x20-]?[0-9]){5,29})")
_SECRET = re.compile(r"[\"']?[\x20]{0,2}[=:][\x20]{0,2}(?:\"([^\"\s]{6,}+)\"|'([^'\s]{6,}+)'|([A-Za-z0-9_\-/+.]{16,}+))")
_PASSWORD = re.compile(r"[\"']?[\x20]{0,2}[=:][\x20]{0,2}([^\s\"'<>,;]{6,}+)")
_BEARER = re.compile(r"\x20{1,2}([A-Za-z0-9_\-/+.~]{16,}+=*)")
_LOGIN = re.compile(r"://[^\s/@<>\"']++@[A-Za-z0-9.-]+[^\s<>\"']*")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,15}$")
_STREET_BEFORE = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[a-zA-Z]?(?:\x20[A-Z][a-z]{1,20}){1,3}\x20$")
_STREET_AFTER = re.compile(r"(?:\x20(?:de|la|el|del|des|du|le|les))?(?:\x20[A-ZÀ-Ý][a-zà-ÿ]{1,20}){1,3},?\x20[0-9]{1,5}(?![0-9A-Za-z])")

# characters of an IBAN by country; others end where a word ends and mod 97 holds
_IBAN_LENGTH = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}

ACCOUNT_CUES = ("account", "acct", "konto", "kontonummer", "compte", "cuenta")
SECRET_CUES = ("token", "api_key", "api-key", "apikey", "secret", "access_key")
PASSWORD_CUES = ("password", "passwd")
BEARER_CUES = ("bearer",)
STREETS_AFTER_NAME = ("Street", "Avenue", "Road", "Lane", "Boulevard", "Drive")   # 12 Oak Street
STREETS_BEFORE_NAME = ("Rue", "rue", "Calle", "calle", "Avenida", "avenida")      # Rue Haute 12


def _automaton():
    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES), ("password", PASSWORD_CUES), ("bearer", BEARER_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                a.add_word(form, (kind, len(form)))
    for kind, cues in (("street", STREETS_AFTER_NAME), ("rue", STREETS_BEFORE_NAME)):
        for cue in cues:
            a.add_word(" " + cue if kind == "street" else cue, (kind, len(cue)))
    a.make_automaton()
    return a


_ANCHORS = None


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    moved = s[4:] + s[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def iban_end_at(text: str, at: int) -> int | None:
    """The end of the IBAN that starts at ``at``."""
    m = _IBAN.match(text, at)
    if not m:
        return None
    end = [i + 1 for i in range(at, m.end()) if text[i] != " "]
    size = _IBAN_LENGTH.get(text[at:at + 2])
    for n in range(len(end), 14, -1) if size is None else [size]:
        if n <= len(end):
            e = end[n - 1]
            follows = text[e:e + 1]
            if not (follows.isascii() and follows.isalnum()) and iban_ok(text[at:e]):
                return e
    return None


def spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """All spans of one text by kind, as (start, end) in code points."""
    global _ANCHORS
    if _ANCHORS is None:
        _ANCHORS = _automaton()
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_end = ip_end = card_end = phone_end = iban_end = login_end = 0

    def add(kind, s, e):
        if not out[kind] or out[kind][-1][1] <= s:
            out[kind].append((s, e))

    for at, (kind, width) in _ANCHORS.iter(text):
        if kind == "digit":
            if at >= ip_end:
                m = _IP.match(text, at)
                if m:
                    ip_end = m.end()
                    if all(map(_small, m.group().split("."))):
                        out["ip"].append(m.span())
                else:
                    ip_end = _DIGITS.match(text, at).end()
            if at >= card_end:
                m = _CARD.match(text, at)
                if m:
                    card_end = m.end()
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append(m.span())
                else:
                    card_end = at + 1
            if at >= 2 and at - 2 >= iban_end and text[at - 1].isupper() and (at < 3 or not text[at - 3].isalnum()):
                end = iban_end_at(text, at - 2)
                if end:
                    iban_end = end
                    add("account", at - 2, end)
        elif kind == "at":
            lo = at
            while lo > email_end and text[lo - 1] in _LOCAL:
                lo -= 1
            if lo < at:
                m = _DOMAIN.match(text, at + 1)
                if m:
                    email_end = m.end()
                    out["email"].append((lo, email_end))
        elif kind == "plus":
            if at >= phone_end:
                m = _PHONE.match(text, at)
                if m:
                    phone_end = m.end()
                    if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                        out["phone"].append(m.span())
        elif kind == "scheme":
            before = at >= login_end and _SCHEME.search(text[max(0, at - 18):at - 2])
            if before:
                m = _LOGIN.match(text, at - 2)
                if m:
                    login_end = m.end()
                    add("login", at - 2 - len(before.group()), login_end)
        elif kind == "account":
            m = _ACCOUNT.match(text, at + 1)
            if m:
                add("account", *m.span(1))
        elif kind == "secret" or kind == "password":
            m = _SECRET.match(text, at + 1)
            if not m and kind == "password":
                m = _PASSWORD.match(text, at + 1)
                if m and not (_LETTER.search(m.group(1)) and _DIGITS.search(m.group(1))):
                    m = None
            if m:
                add("secret", *m.span(m.lastindex))
        elif kind == "bearer":
            m = _BEARER.match(text, at + 1)
            if m:
                add("secret", *m.span(1))
        elif kind == "street":
            end = at + 1
            lo = max(0, end - width - 100)
            m = _STREET_BEFORE.search(text[lo:end - width])
            if m and (end == len(text) or not text[end].isalnum()):
                add("address", lo + m.start(), end)
        else:
            start = at + 1 - width
            m = _STREET_AFTER.match(text, at + 1)
            if m and (start == 0 or not text[start - 1].isalnum()):
                add("address", start, m.end())
    return out


def joined(found: dict, kinds) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in found[k])


def mask(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; spans that
    overlap become one replacement, named by the one that starts first."""
    if not text:
        return text
    every = sorted((s, -e, KINDS.index(k)) for k, ss in spans(text).items() for s, e in ss)
    if not every:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for s, e, k in every:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], -e)
        else:
            merged.append([s, -e, k])
    for s, e, k in merged:
        out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = e
    return "".join(out) + text[at:]


def _find(batches):
    for b in batches:
        counts = {k: [] for k in KINDS}
        digest, every = [], []
        for t in b.column(1).to_pylist():
            found = spans(t or "")
            for k in KINDS:
                counts[k].append(len(found[k]))
            digest.append(hashlib.sha256(joined(found, BASE_KINDS).encode()).hexdigest())
            every.append(joined(found, KINDS))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(digest, pa.string()),
             pa.array(every, pa.string())],
            names=["id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the number of spans of each kind, base_sha256 and spans."""
    bounded_batches(docs.sparkSession)
    schema = ", ".join(["id long", *[f"n_{k} long" for k in KINDS], "base_sha256 string", "spans string"])
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(_find, schema).withColumnRenamed("id", id_col)


def _masker(at):
    def run(batches):
        for b in batches:
            t = pa.array([mask(x) if x else x for x in b.column(at).to_pylist()], b.schema.field(at).type)
            yield b.set_column(at, b.schema.field(at), t)
    return run


def mask_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, personal data in the text replaced."""
    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(_masker(docs.columns.index(text_col)), docs.schema)


def op3_pii(spark, sf_dir: str) -> DataFrame:
    from monthwise.llm.common import table
    return find_spans(table(spark, sf_dir, "documents"))
