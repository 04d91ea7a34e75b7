"""PII: format-preserving Feistel pseudonyms.

Card numbers (Luhn), bank accounts (mod 97), phone numbers, social security numbers, network addresses and calendar dates that validate, and the
secret parts of mail addresses, access keys and assigned passwords or tokens, are permuted by a keyed Feistel network inside their own format:
a card number becomes another valid card number, a date another date. The permutation acts on the value, not on its spelling, so equal values
stay linked across documents and spellings, and no table of values is kept.

Defined results: a null text stays null with no findings; empty texts stay empty; repeated rows get equal pseudonyms; numbers that do not
validate are left alone, but what validates inside them from one group of characters to the end of another is not: the leftmost, then the longest; an empty table gives an empty result; input columns that clash with the new ones are replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ROUNDS = 8
KINDS = ("email", "iban", "secret", "ip", "date", "ssn", "phone", "card")
FIELDS = "text string, n_found long, found array<struct<kind:string,start:int,stop:int>>"
#: Month names of written dates.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


class Feistel:
    """A keyed permutation of range(n) for any n: a balanced network over the next even number of bits, walked until it is back in range."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, half: int, width: int) -> int:
        size = (width + 7) // 8
        d = b""
        block = 0
        while len(d) < size:
            d += hashlib.blake2b(tweak + bytes([i, block]) + half.to_bytes(size, "big"), key=self.key).digest()
            block += 1
        return int.from_bytes(d[:size], "big") & ((1 << width) - 1)

    def permute(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return x
        w = max(1, ((n - 1).bit_length() + 1) // 2)
        t, mask = f"{tweak}/{n}/".encode(), (1 << w) - 1
        while True:
            a, b = x >> w, x & mask
            for i in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
                if back:
                    a, b = b ^ self._round(t, i, a, w), a
                else:
                    a, b = b, a ^ self._round(t, i, b, w)
            x = a << w | b
            if x < n:
                return x


def luhn(digits: str) -> int:
    """The digit that, put after ``digits``, makes a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 if i % 2 else 2)
        total += v - 9 if v > 9 else v
    return -total % 10


def mod97(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s)) % 97


PATTERN = re.compile(
    r"""(?P<email>[A-Za-z0-9][A-Za-z0-9._%+\-]*@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,})
    |(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])
    |(?<![A-Za-z0-9])(?P<secret>(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])
        |gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}
        |(?i:passwords?|passwd|pwd|secret|token|api[_\-]?key|access[_\-]?key)\s*[=:]\s*["']?(?P<value>[A-Za-z0-9+/_\-]{6,}))
    |(?<![\d.])(?P<ip>(?:\d{1,3}\.){3}\d{1,3})(?!\d|\.\d)
    |(?<!\d)(?P<date>\d{4}-\d{2}-\d{2}|\d{1,2}([/.])\d{1,2}\g<DSEP>\d{4})(?!\d)
    |(?<![A-Za-z0-9])(?P<written>\d{1,2}\ (?:MONTHS)\ \d{4}|(?:MONTHS)\ \d{1,2},\ \d{4})(?!\d)
    |(?<![\d-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])
    |(?<![\w+])(?P<phone>\+\d{1,3}[\ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[\ .\-]?\d{2,4}){1,4}|\(\d{3}\)\ ?\d{3}[\-.\ ]\d{4}|\d{3}[\-.]\d{3}[\-.]\d{4})(?!\d)
    |(?<!\d)(?P<card>\d(?:[\ \-]?\d){12,18})(?!\d)""".replace(r"([/.])\d{1,2}\g<DSEP>", r"(?P<dsep>[/.])\d{1,2}(?P=dsep)").replace("MONTHS", "|".join(MONTHS)),
    re.X,
)
CARD = re.compile(r"(?<!\d)\d(?:[ \-]?\d){12,18}(?!\d)")
HEAD = re.compile(r"[A-Za-z0-9]+|.", re.S)
GROUPS = (*KINDS, "written")
ANY = re.compile(r"[0-9@]|AKIA|ASIA|(?i:passw|pwd|secret|token|key)")


class Pseudonyms:
    def __init__(self, key: bytes):
        self.f = Feistel(key)
        self.cached = lru_cache(maxsize=50_000)(self._replace)

    def _digits(self, d: str, tweak: str) -> str:
        return str(self.f.permute(int(d), 10 ** len(d), tweak)).zfill(len(d)) if d else d

    def _classes(self, s: str, tweak: str) -> str:
        """Letters stay letters of their case, digits stay digits, the rest stays."""
        hexed = tweak == "secret" and re.fullmatch(r"[0-9a-f]+", s) and len(s) >= 8
        sets = [("0123456789abcdef" if hexed else "0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if "a" <= c <= "z" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if "A" <= c <= "Z" else c) for c in s]
        x = n = 0
        n = 1
        for c, alphabet in zip(s, sets, strict=True):
            x, n = x * len(alphabet) + alphabet.index(c), n * len(alphabet)
        x = self.f.permute(x, n, tweak)
        out = []
        for alphabet in reversed(sets):
            x, r = divmod(x, len(alphabet))
            out.append(alphabet[r])
        return "".join(reversed(out))

    @staticmethod
    def _fill(shape: str, digits: str) -> str:
        it = iter(digits)
        return "".join(next(it) if c.isdigit() else c for c in shape)

    def _date(self, s: str) -> str | None:
        try:
            if m := re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)", s):
                day = dt.date(*map(int, m.groups()))
            elif m := re.fullmatch(r"(\d{1,2})([/.])(\d{1,2})[/.](\d{4})", s):
                a, b, y = int(m[1]), int(m[3]), int(m[4])
                first = m[2] == "/" and a <= 12  # 3/4/2020: month first unless it can't be
                day = dt.date(y, a, b) if first else dt.date(y, b, a)
            elif m := re.fullmatch(r"(\d{1,2}) (\w+) (\d{4})", s):
                day = dt.date(int(m[3]), MONTHS.index(m[2]) + 1, int(m[1]))
            else:
                m = re.fullmatch(r"(\w+) (\d{1,2}), (\d{4})", s)
                day = dt.date(int(m[3]), MONTHS.index(m[1]) + 1, int(m[2]))
        except ValueError:
            return None
        if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
            return None
        n = LAST_DAY - FIRST_DAY + 1
        new = dt.date.fromordinal(FIRST_DAY + self.f.permute(day.toordinal() - FIRST_DAY, n, "date"))
        if "-" in s:
            return new.isoformat()
        if m := re.fullmatch(r"(\d{1,2})([/.])(\d{1,2})[/.](\d{4})", s):
            a, b = (new.month, new.day) if m[2] == "/" and int(m[1]) <= 12 else (new.day, new.month)
            if m[2] == "/" and int(m[1]) > 12 and a <= 12:  # must still be read day first
                a, b = (new.day, new.month) if new.day > 12 else (new.month, new.day)
            return f"{a:0{len(m[1])}d}{m[2]}{b:0{len(m[3])}d}{m[2]}{new.year}"
        if s[0].isdigit():
            return f"{new.day} {MONTHS[new.month - 1]} {new.year}"
        return f"{MONTHS[new.month - 1]} {new.day}, {new.year}"

    def _replace(self, kind: str, s: str) -> str | None:
        """The pseudonym, or None if the value does not validate."""
        digits = re.sub(r"\D", "", s)
        if kind == "email":
            local, _, host = s.partition("@")
            return self._classes(local, "email/" + host.lower()) + "@" + host
        if kind == "card":
            if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
                return None
            body = self._digits(digits[:-1], "card")
            return self._fill(s, body + str(luhn(body)))
        if kind == "iban":
            flat = s.replace(" ", "")
            if not 15 <= len(flat) <= 34 or mod97(flat[4:] + flat[:4]) != 1:
                return None
            body = self._classes(flat[4:], "iban/" + flat[:2])
            it = iter(flat[:2] + f"{98 - mod97(body + flat[:2] + '00'):02d}" + body)
            return "".join(c if c == " " else next(it) for c in s)
        if kind == "ip":
            parts = [int(x) for x in s.split(".")]
            if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
                return None
            x = self.f.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
            return ".".join(map(str, x.to_bytes(4, "big")))
        if kind == "ssn":
            good = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
            if not good(digits):
                return None
            while not good(digits := self._digits(digits, "ssn")):
                pass
            return self._fill(s, digits)
        if kind == "phone":
            if not 7 <= len(digits) <= 15:
                return None
            code = re.match(r"\+(\d{1,3})(?=[ .\-(])", s)
            k = len(code[1]) if code else len(digits) - 10 if s[0] == "+" and len(digits) > 10 else 0
            return self._fill(s, digits[:k] + self._digits(digits[k:], "phone"))
        if kind in ("date", "written"):
            return self._date(s)
        raise ValueError(kind)

    def _secret(self, s: str, value: str | None) -> str:
        if value is None:
            k = s.index("_") + 1 if s.startswith("gh") else s.index("-") + 1 if s.startswith("sk-") else 4
            return s[:k] + self._classes(s[k:], "secret")
        return s[: len(s) - len(value)] + self._classes(value, "secret")

    def _shorter(self, text: str, a: int, kind: str, s: str) -> tuple:
        """The longest value at ``a`` that validates and ends with a group of the candidate ``s``, or else of a card number: kind, value, pseudonym."""
        tried = [(kind, s)] if kind in ("iban", "phone") else []
        if c := CARD.match(text, a):
            tried.append(("card", c.group()))
        for kind, s in tried:
            if kind == "phone" and any(self._shorter(text, a + g.start(), "", "")[2] for g in re.finditer(r"\d+", s)):
                continue  # the card number in it comes first
            for value in (s, *(s[: g.start()] for g in reversed([*re.finditer(r"[ .\-]", s)]))):
                if new := self.cached(kind, value):
                    return kind, value, new
        return kind, s, None

    def apply(self, text: str | None) -> tuple:
        if not text or not ANY.search(text):
            return text, 0, []
        out, at, found, size = [], 0, [], 0
        m = PATTERN.search(text)
        while m:
            a, kind, s = m.start(), next(k for k in GROUPS if m[k] is not None), m.group()
            new = self._secret(s, m["value"]) if kind == "secret" else self.cached(kind, s)
            if new is None:
                kind, s, new = self._shorter(text, a, kind, s)
            if new is None:
                m = PATTERN.search(text, HEAD.match(text, a).end())
                continue
            gap = text[at:a]
            out += [gap, new]
            size += len(gap)
            found.append({"kind": "date" if kind == "written" else kind, "start": size, "stop": size + len(new)})
            size += len(new)
            at = a + len(s)
            m = PATTERN.search(text, at)
        out.append(text[at:])
        return "".join(out), len(found), found


#: The setting of the session that holds the secret key, and the key of sessions without one: known to anyone, so fit for tests only.
KEY_SETTING, TEST_KEY = "spark.bisque.pii.key", "bisque-default-key"


def session_key(spark: SparkSession) -> bytes:
    return spark.conf.get(KEY_SETTING, TEST_KEY).encode()


def pseudonymize(df: DataFrame, key: bytes, column: str = "text") -> DataFrame:
    """``df`` with the text's values replaced, their number, and kind and place of each in the new text."""

    def make():
        p = Pseudonyms(key)
        return lambda texts: dict(zip(("text", "n_found", "found"), zip(*map(p.apply, texts)), strict=True))

    given = df if column == "text" else common.without(df, ["text"]).withColumnRenamed(column, "text")
    return common.map_text(given, "text", FIELDS, make)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return pseudonymize(docs, session_key(spark)).select("doc_id", "n_found", *counts, F.length("text").cast("long").alias("n_chars"), "text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their values replaced and n_chars counted anew."""
    return pseudonymize(docs, session_key(spark)).select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
