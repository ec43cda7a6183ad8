"""Format-preserving pseudonyms for personal data.

Numbers, dates and addresses are found by pattern and kept only where they are valid
(check digits, ranges, calendar). Secrets are what follows a word that announces them, up to
white space or the closing quote. Each is permuted under a key among the valid values of
its own format: a card stays a card with a right check digit, a date a date. It is one
permutation for a kind of value, whatever its separators, so equal values stay linked
across documents, and different ones apart. Who has the key can go back
(``Pseudonyms(key, back=True)``).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable
from datetime import date
from ipaddress import IPv6Address

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .columns import with_outputs
from .feistel import Feistel

SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", IntegerType()),
            StructField("stop", IntegerType()),
            StructField("pseudonym", StringType()),
        ]
    )
)
FOUND = StructType([StructField("text", StringType()), StructField("spans", SPANS)])
_ARROW = pa.struct(
    [
        ("text", pa.string()),
        ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("pseudonym", pa.string())]))),
    ]
)

_DIGIT = re.compile(r"[0-9]")
_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
)
_SECRET = re.compile(
    r"(?<![A-Za-z0-9])(?:(?P<aws>AKIA[0-9A-Z]{16})(?![0-9A-Za-z])"
    r"|(?ai:authorization)[\"']?[ \t]{0,4}[:=][ \t]{0,4}[\"']?(?ai:bearer|basic|token)[ \t]{1,4}(?P<header>[^\s\"']++)"
    r"|(?ai:bearer)[ \t]{1,4}(?P<bearer>[A-Za-z0-9._~+/=\-]++)"
    r"|(?ai:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)[\"']?[ \t]{0,4}[:=][ \t]{0,4}"
    r"(?:\"(?P<double>[^\"\r\n]++)\"|'(?P<single>[^'\r\n]++)'|[\"']?(?P<plain>[^\s\"']++)))"
)
"""Values go on to white space or their closing quote, however long."""
_MIXED = re.compile(r"[a-z][A-Z]")
_AFTER = ".,;:!?)]}>"
"""Signs at the end of a value without quotes that belong to the sentence."""
SHORTEST = 8
CHUNK = 256
"""Signs that are permuted together; longer values are permuted piece by piece."""
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?!\w|:[0-9A-Fa-f:]|\.[0-9])")
_TOLD = re.compile(
    r"(?<![A-Za-z])(?ai:phone|telephone|tel|mobile|cell|call|fax|sms)[ \t.:#=]{0,4}(?ai:(?:number|no|us|me|at|on|is)[ \t.:#]{1,3}){0,3}"
    r"(?P<us>[2-9][0-9]{2}[2-9][0-9]{6})(?![0-9])"
)
"""Ten digits without separators are a phone number only where a word says so."""
_SECRET_WORDS = ("akia", "authorization", "bearer", "token", "secret", "passw", "pwd", "api", "access")
_PHONE_WORDS = ("phone", "tel", "mobile", "cell", "call", "fax", "sms")
"""Parts of words without which these patterns match nowhere, looked for first."""
_NUMBER = re.compile(
    r"(?<![\w.])(?:"
    r"(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![\w]|\.[0-9])"
    r"|(?P<iso>[0-9]{4}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2})(?![0-9]|[-/.][0-9])"
    r"|(?P<day>[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)[0-9]{4})(?![0-9]|[-/.][0-9])"
    r"|(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9]|-[0-9])"
    r"|(?P<card>[0-9]{13,19}|[0-9]{4}(?P<s3>[ -])[0-9]{4}(?P=s3)[0-9]{4}(?P=s3)[0-9]{1,7}|[0-9]{4}(?P<s4>[ -])[0-9]{6}(?P=s4)[0-9]{5})(?![0-9])"
    r"|(?P<us>(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+1[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4})(?![0-9])"
    r"|(?P<phone>\+[2-9][0-9]{0,2}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,12}(?:[ .-][0-9]{1,12}){0,7})(?![0-9])"
    r"|(?P<iban>[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?))(?![A-Za-z0-9])"
    r")"
)

_SPACED = re.compile(r"[ .-]")


def luhn_digit(body: str) -> int:
    """The check digit that follows ``body``."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _refill(shape: str, digits: str) -> str:
    """The digits in place of those of ``shape``."""
    rest = iter(digits)
    return "".join(next(rest) if "0" <= c <= "9" else c for c in shape)


class Pseudonyms:
    """Replaces values; every method gives None for a value that is not valid."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.feistel, self.back = Feistel(key), back
        self.seen: dict[tuple[str, str], str | None] = {}

    def _move(self, x: int, size: int, tweak: str, inside: Callable[[int], bool] | None = None) -> int:
        return self.feistel.permute(x, size, tweak.encode(), inside, self.back)

    def letters(self, text: str, tweak: str, hexadecimal: bool = False) -> str:
        """ASCII letters and digits permuted together, each within its own class; other
        signs are the format. Of a text longer than ``CHUNK`` each piece is permuted under
        a key that depends on the pseudonym of the piece before."""
        hexadecimal = hexadecimal and re.fullmatch(r"[0-9a-f]+", text) is not None
        out: list[str] = []
        for at in range(0, max(len(text), 1), CHUNK):
            piece = text[at : at + CHUNK]
            after = "" if not at else f"/{text[at - CHUNK : at] if self.back else out[-1]}"
            out.append(self._piece(piece, tweak + after, hexadecimal))
        return "".join(out)

    def _piece(self, text: str, tweak: str, hexadecimal: bool) -> str:
        if hexadecimal:
            return f"{self._move(int(text, 16), 16 ** len(text), f'{tweak}/x{len(text)}'):0{len(text)}x}"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        base = [10 if "0" <= c <= "9" else 26 if "a" <= c <= "z" else 1 for c in low]
        x, size = 0, 1
        for c, b in zip(low, base):
            x = x * b + (int(c) if b == 10 else ord(c) - 97 if b == 26 else 0)
            size *= b
        shape = "".join("9" if b == 10 else "a" if b == 26 else c for c, b in zip(low, base))
        x = self._move(x, size, f"{tweak}/{shape}")
        out = []
        for c, b in zip(reversed(text), reversed(base)):
            x, d = divmod(x, b)
            out.append(str(d) if b == 10 else c if b == 1 else chr((65 if c.isupper() else 97) + d))
        return "".join(reversed(out))

    def email(self, text: str) -> str:
        name, _, host = text.rpartition("@")
        labels, _, top = host.rpartition(".")
        return f"{self.letters(name, 'name')}@{self.letters(labels, 'host')}.{top}"

    def secret(self, text: str) -> str:
        if re.fullmatch("AKIA[0-9A-Z]{16}", text):
            digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
            x = self._move(int(text[4:], 36), 36**16, "akia")
            out = ""
            for _ in range(16):
                x, d = divmod(x, 36)
                out = digits[d] + out
            return "AKIA" + out
        return self.letters(text, "secret", hexadecimal=True)

    def ip(self, text: str) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        x = self._move(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip")
        return ".".join(map(str, x.to_bytes(4, "big")))

    def ipv6(self, text: str) -> str | None:
        """The hexadecimal digits permuted in place, so an address is linked as it is
        written. Capital letters stay so; mixed ones become capitals. A decimal digit is
        among them before and after, which tells addresses from names such as ``a::b``."""
        try:
            IPv6Address(text)
        except ValueError:
            return None
        n = text.replace(":", "")
        upper = n != n.lower()

        def written(v: int) -> str:
            return f"{v:0{len(n)}x}"

        def inside(v: int) -> bool:
            w = written(v)
            return _DIGIT.search(w) is not None and (not upper or not w.isdigit())

        if not n or not inside(int(n, 16)):
            return None
        shape = "".join(":" if c == ":" else "x" for c in text)
        new = written(self._move(int(n, 16), 16 ** len(n), f"ipv6/{upper}/{shape}", inside))
        rest = iter(new.upper() if upper else new)
        return "".join(c if c == ":" else next(rest) for c in text)

    def ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        x = ((area - 1) * 99 + group - 1) * 9999 + serial - 1
        x = self._move(x, 899 * 99 * 9999, "ssn", lambda v: v // (99 * 9999) != 665)
        area, rest = divmod(x, 99 * 9999)
        group, serial = divmod(rest, 9999)
        return f"{area + 1:03d}-{group + 1:02d}-{serial + 1:04d}"

    def card(self, text: str) -> str | None:
        """All but the first digit is permuted; the last checks the others."""
        n = _digits(text)
        if luhn_digit(n[:-1]) != int(n[-1]) or not n.strip("0"):
            return None
        size = 10 ** (len(n) - 2)
        body = n[0] + f"{self._move(int(n[1:-1]), size, f'card/{len(n)}/{n[0]}'):0{len(n) - 2}d}"
        return _refill(text, body + str(luhn_digit(body)))

    def us(self, text: str) -> str | None:
        """A number of the North American plan; a country code in front stays."""
        n = _digits(text)[-10:]
        if n[0] < "2" or n[3] < "2":
            return None
        x = ((int(n[:3]) - 200) * 800 + int(n[3:6]) - 200) * 10_000 + int(n[6:])
        x = self._move(x, 800 * 800 * 10_000, "us")
        x, line = divmod(x, 10_000)
        area, exchange = divmod(x, 800)
        lead = _digits(text)[:-10]
        return _refill(text, f"{lead}{area + 200}{exchange + 200}{line:04d}")

    def phone(self, text: str) -> str | None:
        """An international number: what follows the country code is permuted."""
        n = _digits(text)
        if not 8 <= len(n) <= 15:
            return None
        first = re.match(r"\+[0-9]{1,3}(?![0-9])", text)
        lead = n[: len(first[0]) - 1 if first else 2]
        rest = n[len(lead) :]
        return _refill(text, lead + f"{self._move(int(rest), 10 ** len(rest), f'phone/{lead}/{len(rest)}'):0{len(rest)}d}")

    def iban(self, text: str) -> str | None:
        n = text.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(n) <= 34 or number(n[4:] + n[:4]) % 97 != 1:
            return None
        body = self.letters(n[4:], f"iban/{n[:2]}")
        check = 98 - number(body + n[:2] + "00") % 97
        rest = iter(f"{n[:2]}{check:02d}{body}")
        return "".join(c if c == " " else next(rest) for c in text)

    def _moved_day(self, day: date) -> date:
        """Within the days of 1900 to 2099, or else among all others."""
        lo, hi = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
        x = day.toordinal()
        if lo <= x <= hi:
            return date.fromordinal(self._move(x - lo, hi - lo + 1, "day") + lo)
        far = lambda v: not lo <= v + 1 <= hi
        return date.fromordinal(self._move(x - 1, date.max.toordinal(), "far", far) + 1)

    @staticmethod
    def _day(y: str, m: str, d: str) -> date | None:
        try:
            return date(int(y), int(m), int(d))
        except ValueError:
            return None

    @staticmethod
    def _like(parts: list[int], old: list[str]) -> list[str]:
        """Padded with zeros unless one of the old parts is a single digit."""
        padded = all(len(o) >= 2 for o in old)
        return [f"{p:0{len(o) if len(o) == 4 else 2 if padded else 1}d}" for p, o in zip(parts, old)]

    def iso(self, text: str) -> str | None:
        sep, old = text[4], text.split(text[4])
        day = self._day(*old)
        if day is None:
            return None
        new = self._moved_day(day)
        return sep.join(self._like([new.year, new.month, new.day], old))

    def day(self, text: str) -> str | None:
        """Month first if that is a date, else day first; with dots, day first."""
        sep = next(c for c in text if not "0" <= c <= "9")
        old = text.split(sep)
        a, b, y = old
        month_first = self._day(y, a, b) if sep != "." else None
        day = month_first or self._day(y, b, a)
        if day is None:
            return None
        new = self._moved_day(day)
        parts = [new.month, new.day] if month_first else [new.day, new.month]
        return sep.join(self._like([*parts, new.year], old))

    def of(self, kind: str, value: str) -> str | None:
        at = (kind, value)
        if len(value) > CHUNK:
            return getattr(self, kind)(value)
        if at not in self.seen:
            if len(self.seen) > 100_000:
                self.seen.clear()
            self.seen[at] = getattr(self, kind)(value)
        return self.seen[at]

    def number(self, m: re.Match[str]) -> tuple[int, int, str, str] | None:
        """The span of a match of ``_NUMBER``. Phone numbers and IBANs may have taken what
        follows them: ends before a later group are tried too. A phone number ends
        before another value, else as late as it can, rather at a space."""
        kind = next(k for k in ("ip", "iso", "day", "ssn", "card", "us", "phone", "iban") if m[k])
        text, (start, stop) = m.string, m.span()
        ends = [stop]
        if kind in ("phone", "iban"):
            cuts = [start + c.start() for c in _SPACED.finditer(m[0])][::-1]
            spaces = [c for c in cuts if text[c] == " "]
            ends += spaces
            if kind == "phone":
                ends = [c for c in spaces[::-1] if self._other_at(text, c + 1)] + ends + [c for c in cuts if text[c] != " "]
        for end in ends:
            new = self.of(kind, text[start:end])
            if new is not None:
                return start, end, kind, new
        return None

    def _other_at(self, text: str, at: int) -> bool:
        m = _NUMBER.match(text, at)
        kind = m and next((k for k in ("ip", "iso", "day", "ssn", "card") if m[k]), None)
        return bool(kind) and self.of(kind, m[0]) is not None

    def secrets(self, text: str) -> list[tuple[int, int, str, str]]:
        """Keys and what follows a word that announces a secret, if it is ``SHORTEST`` or
        longer and holds a digit, which tells it from prose; in an authorization header
        capitals after small letters do too."""
        found = []
        for m in _SECRET.finditer(text):
            kind = m.lastgroup
            value = m[kind].rstrip(_AFTER) if kind in ("header", "bearer", "plain") else m[kind]
            if kind == "aws" or len(value) >= SHORTEST and (_DIGIT.search(value) or kind == "header" and _MIXED.search(value)):
                start = m.start(kind)
                found.append((start, start + len(value), "secret", self.of("secret", value)))
        return found

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """``(start, stop, kind, pseudonym)`` in order; where two overlap, secrets go
        before addresses and these before numbers, then the earlier."""
        found: list[tuple[int, int, str, str]] = []
        low = text.lower()
        if any(w in low for w in _SECRET_WORDS):
            found += self.secrets(text)
        if "@" in text:
            for m in _EMAIL.finditer(text):
                own = m[0].lstrip(".-")
                if not own.startswith("@"):
                    found.append((m.end() - len(own), m.end(), "email", self.of("email", own)))
        if _DIGIT.search(text):
            if "::" in text or text.count(":") >= 7:
                for m in _IPV6.finditer(text):
                    own = m[0] if m[0].endswith("::") else m[0].removesuffix(":")
                    new = self.of("ipv6", own)
                    if new is not None:
                        found.append((m.start(), m.start() + len(own), "ipv6", new))
            for m in _TOLD.finditer(text) if any(w in low for w in _PHONE_WORDS) else ():
                new = self.of("us", m["us"])
                if new is not None:
                    found.append((*m.span("us"), "us", new))
            m = _NUMBER.search(text)
            while m:
                span = self.number(m)
                if span:
                    found.append(span)
                m = _NUMBER.search(text, span[1] if span else m.start() + 1)
        order = {"secret": 0, "email": 1}
        out: list[tuple[int, int, str, str]] = []
        starts: list[int] = []
        for span in sorted(found, key=lambda s: (order.get(s[2], 2), s[0])):
            i = bisect_left(starts, span[0])
            before = i == 0 or out[i - 1][1] <= span[0]
            after = i == len(out) or span[1] <= out[i][0]
            if before and after:
                starts.insert(i, span[0])
                out.insert(i, span)
        return out

    def text(self, text: str) -> tuple[str, list[tuple[int, int, str, str]]]:
        spans = self.spans(text)
        parts, at = [], 0
        for start, stop, _, new in spans:
            parts += [text[at:start], new]
            at = stop
        return "".join([*parts, text[at:]]), spans


def pseudonymise(
    docs: DataFrame, key: bytes, text_col: str = "text", back: bool = False
) -> DataFrame:
    """``docs`` with pseudonyms in the text, and ``pii_spans`` (kind, start and stop in
    code points of the original text, pseudonym) and ``n_pii``.

    Kinds: email, secret, ip, ipv6, iso and day (dates), ssn, card, us and phone, iban.
    Values that are not valid stay. A null text stays null with no spans; an empty one is
    empty. Rows are taken one by one, so repeated rows come out alike. All other columns
    are passed through; an input column named like an output is replaced.
    """

    @F.arrow_udf(FOUND)
    def run(texts: pa.Array) -> pa.Array:
        names = Pseudonyms(key, back)
        rows = []
        for t in texts.to_pylist():
            new, spans = names.text(t) if t else (t, [])
            rows.append({"text": new, "spans": [dict(zip(("start", "stop", "kind", "pseudonym"), s)) for s in spans]})
        return pa.array(rows, _ARROW)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("found", run(F.col("row").getField(text_col).cast("string")))
    spans = F.col("found.spans")
    return with_outputs(
        rows, docs.columns, **{text_col: F.col("found.text"), "pii_spans": spans, "n_pii": F.size(spans).cast("bigint")}
    )
