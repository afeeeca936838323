"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations in SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import free_name

#: Key of the registered queries and the pipeline, which must give the same rows everywhere. It is no secret: pass one of your
#: own, kept secret, wherever pseudonyms must not be traced back.
EXAMPLE_KEY = "parley-pseudonyms"
ROUNDS = 8

_MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_MIDDLE = r"(?:-[0-9]{1,2}-|/[0-9]{1,2}/|\.[0-9]{1,2}\.)"
_NUMERIC_DATE = rf"(?:[0-9]{{4}}{_MIDDLE}[0-9]{{1,2}}|[0-9]{{1,2}}{_MIDDLE}[0-9]{{4}})(?![0-9-]|[/.][0-9])"
_NAMED_DATE = rf"(?i:[0-9]{{1,2}}(?:st|nd|rd|th)?\.? (?:of )?{_MONTH}\.?,? [0-9]{{4}}|{_MONTH}\.? [0-9]{{1,2}}(?:st|nd|rd|th)?,? [0-9]{{4}})(?![0-9])"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_LOCAL = r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
#: What a run of digit groups ends before.
_OTHER = rf"(?!{_SSN}|{_NUMERIC_DATE}|{_LOCAL})"
#: What stands before a secret; the quote is part of it.
_SET = r"[\"']?\s{0,3}(?:=>|:=|==?|:)\s{0,3}"
_WORD_KEY = rf"(?i:password|passwd|passphrase|passcode|pwd){_SET}"
_OTHER_KEY = rf"(?i:(?:api|access|secret|private|auth|account|encryption|signing|master)[_ -]?key(?:[_ -]?id)?|secret|token|credentials?){_SET}"
_BEARER = r"(?i:\bbearer)\s{1,3}"
_PEM = r"-----BEGIN (?:[A-Z0-9]{1,20} ){0,3}PRIVATE KEY-----"
_BEFORE_SECRET = rf"^(?:(?:{_WORD_KEY}|{_OTHER_KEY})[\"']?|{_BEARER}|{_PEM})"
_QUOTED = r"\"[^\"\n]{4,}+(?=\")|'[^'\n]{4,}+(?=')"
_BARE = r"[^\s\"'<>&,;]"
_KNOWN_KEYS = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}", r"gh[pousr]_[0-9A-Za-z]{20,}+", r"github_pat_[0-9A-Za-z_]{20,}+", r"glpat-[0-9A-Za-z_-]{20,}+", r"sk-[0-9A-Za-z_-]{16,}+",
    r"[spr]k_(?:live|test)_[0-9A-Za-z]{10,}+", r"xox[abeprs]-[0-9A-Za-z-]{10,}+", r"AIza[0-9A-Za-z_-]{35}", r"(?<![_-])eyJ[0-9A-Za-z_-]{8,}+\.eyJ[0-9A-Za-z_-]{8,}+\.[0-9A-Za-z_-]*+",
)

_LABEL = r"[A-Za-z0-9-]"
#: Labels of a host that can't be its last; all repeated groups are possessive, which needs no stack however long the text.
_INNER = rf"(?:\.(?![A-Za-z]{{2}}){_LABEL}++)*+"
_TOP = r"\.[A-Za-z]{2,}+"
_MAILBOX = r"[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}0-9._%+-]"

#: One pattern per kind, tried in this order. Numbers and dates are validated once found; what fails stays as it is.
PATTERNS = {
    "secret": rf"{_WORD_KEY}(?:{_QUOTED}|{_BARE}{{4,}}(?<![.!?:]))|{_OTHER_KEY}(?:{_QUOTED}|(?={_BARE}{{16}}|{_BARE}{{0,15}}[0-9]){_BARE}{{8,}}(?<![.!?:]))"
    rf"|{_BEARER}[0-9A-Za-z._~+/=-]{{16,}}(?<![.])|{_PEM}[^-]{{16,}}+(?=-----END)|(?<![0-9A-Za-z])(?:{'|'.join(_KNOWN_KEYS)})",
    "email": rf"(?<!{_MAILBOX}){_MAILBOX}++@{_LABEL}++{_INNER}{_TOP}(?:{_LABEL}*+{_INNER}{_TOP})*+",
    "phone": r"(?<![0-9]|[0-9][.-])(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    rf"|(?<![0-9A-Za-z+])\+[0-9](?:[0-9]|[ .()/-]{{1,2}}{_OTHER}[0-9]){{6,14}}(?![0-9])",
    "ssn": rf"(?<![0-9-]){_SSN}",
    "date": rf"(?<![0-9-]|[0-9][/.]){_NUMERIC_DATE}|(?<![0-9A-Za-z]){_NAMED_DATE}",
    "card": rf"(?<![0-9])[0-9](?:[0-9]|[ -]{_OTHER}[0-9]){{12,}}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
}
#: The days of 400 years of the calendar, which repeat: 189 * 773. They begin with 1800-01-01.
_DAYS = (189, 773)
_FIRST_DAY = "1800-01-01"


def feistel(kind: str | Column, left: Column, right: Column, sizes: tuple[int | Column, int | Column], key: str, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of pairs with left below sizes[0] and right below sizes[1], as a struct (l, r).

    Even rounds shift the left half by a keyed hash of the right one, odd rounds the other way about; each shift can
    be undone, so the whole is one-to-one on the pairs.
    """

    def shift(i: Column, half: Column, size: int) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") % size

    def one(acc: Column, i: Column) -> Column:
        l, r = acc["l"], acc["r"]  # noqa: E741
        even = i % 2 == 0
        return F.struct(
            F.when(even, (l + shift(i, r, sizes[0])) % sizes[0]).otherwise(l).alias("l"),
            F.when(even, r).otherwise((r + shift(i, l, sizes[1])) % sizes[1]).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, one)


def _letting(value: Column, then) -> Column:
    """`then` of a column that is worked out once."""
    return F.transform(F.array(value), then)[0]


def _padded(value: Column, digits: int) -> Column:
    return F.lpad(value.cast("string"), digits, "0")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _part(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length).cast("long")


def _luhn_sum(digits: Column) -> Column:
    """The checksum of digits before the check digit, whose own place counts once."""

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _check_digit(digits: Column) -> Column:
    return ((10 - _luhn_sum(digits) % 10) % 10).cast("string")


def _refill(shape: Column, digits: Column) -> Column:
    """The digits in the places where `shape` has digits, its other characters kept."""
    places = F.split(F.regexp_replace(shape, "[0-9]", "0"), "")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def one(acc: Column, c: Column) -> Column:
        digit = c == "0"
        return F.struct(
            F.concat(acc["out"], F.when(digit, F.substring(digits, acc["at"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["at"] + digit.cast("int")).alias("at"),
        )

    return F.aggregate(places, start, one)["out"]


def _halves(digits: Column, kind: str | Column, key: str) -> Column:
    """Other digits, as many, by a permutation of the numbers of this length."""
    n = F.floor(F.length(digits) / 2).cast("int")
    m = F.length(digits) - n
    sizes = tuple(F.pow(F.lit(10.0), k).cast("long") for k in (n, m))
    moved = feistel(kind, F.substring(digits, F.lit(1), n).cast("long"), F.substring(digits, n + 1, m).cast("long"), sizes, key)
    return _letting(moved, lambda x: F.concat(F.lpad(x["l"].cast("string"), n, F.lit("0")), F.lpad(x["r"].cast("string"), m, F.lit("0"))))


def _card_right(digits: Column) -> Column:
    """13 to 19 digits whose checksum, taken two at a time from the right, ends in 0."""
    pairs = F.array(*(F.lit((2 * (n // 10) - 9 * (n // 10 > 4)) + n % 10) for n in range(100)))
    padded = F.lpad(digits, 20, "0")
    total = sum((F.element_at(pairs, F.substring(padded, k, 2).cast("int") + 1) for k in range(1, 20, 2)), F.lit(0))
    return F.length(digits).between(13, 19) & (total % 10 == 0)


def card(text: Column, key: str) -> Column:
    """13 to 19 digits with a right check digit: the first digit stays, those in the middle are permuted, the last is worked out anew."""

    def of(d: Column) -> Column:
        def put(middle: Column) -> Column:
            body = F.concat(F.substring(d, 1, 1), middle)
            return _refill(text, F.concat(body, _check_digit(body)))

        new = _letting(_halves(F.substring(d, F.lit(2), F.length(d) - 2), "card", key), put)
        return F.when(_card_right(d), new).otherwise(text)

    return _letting(_digits(text), of)


#: Groups with a card that are gone through at once; the picks of one such lot are copied as they are made.
_LOT = 256


def _card_end(groups: Column, i: Column) -> Column:
    """The last group of the longest card that begins with group i; null if none does.

    Of the next groups, at most 40 characters matter: 19 digits and what parts them. Each digit that ends a group is marked,
    and a card is a run of digits up to a mark.
    """

    def among(held: Column) -> Column:
        def marked(both: Column) -> Column:
            lengths = F.filter(F.array(*map(F.lit, range(19, 12, -1))), lambda n: (F.substring(both["marks"], n, F.lit(1)) == "x") & _card_right(F.substring(both["digits"], F.lit(1), n)))
            return _letting(F.get(lengths, F.lit(0)), lambda n: i - 1 + n - F.length(F.replace(F.substring(both["marks"], F.lit(1), n), F.lit("x"), F.lit(""))))

        return _letting(F.struct(F.replace(held, F.lit(" "), F.lit("")).alias("digits"), F.regexp_replace(held, "[0-9](?: |$)", "x").alias("marks")), marked)

    return F.when(F.length(groups[i]) < 20, _letting(F.substring(F.array_join(F.slice(groups, i + 1, 19), " "), 1, 40), among))


def _picked(ends: Column) -> Column:
    """Of the groups that begin a card, from the left, those that no card before reaches: an array of (i, j), first and last group."""
    pair = "array<struct<i:int,j:int>>"

    def one(acc: Column, i: Column) -> Column:
        taken = F.struct((ends[i] + 1).alias("next"), F.concat(acc["picks"], F.array(F.struct(i.alias("i"), ends[i].alias("j")))).alias("picks"))
        return F.when(i < acc["next"], acc).otherwise(taken)

    def of(begins: Column) -> Column:
        def lot(acc: Column, at: Column) -> Column:
            start = F.struct(acc["next"].alias("next"), F.array().cast(pair).alias("picks"))
            return _letting(F.aggregate(F.slice(begins, at + 1, _LOT), start, one), lambda x: F.struct(x["next"].alias("next"), F.concat(acc["picks"], F.array(x["picks"])).alias("picks")))

        start = F.struct(F.lit(0).alias("next"), F.array().cast(f"array<{pair}>").alias("picks"))
        lots = F.sequence(F.lit(0), F.size(begins) - 1, F.lit(_LOT))
        return F.when(F.size(begins) == 0, F.array().cast(pair)).otherwise(F.flatten(F.aggregate(lots, start, lot)["picks"]))

    return _letting(F.filter(F.sequence(F.lit(0), F.size(ends) - 1), lambda i: ends[i].isNotNull()), of)


def _cards(run: Column, key: str) -> Column:
    """A struct (put, swaps): a run of groups of digits with its cards replaced, each from the first group that begins one to the last that ends it.

    Every group is looked at once with the 18 after it, and the pieces are joined once, so time is linear in the run.
    """

    def of(groups: Column) -> Column:
        after = F.slice(F.split(run, "[0-9]+"), F.lit(2), F.size(groups))  # what parts each group from the next

        def pieces(spaced: Column) -> Column:
            def text(first: Column, n: Column) -> Column:
                return F.array_join(F.slice(spaced, first + 1, n), "")

            def chosen(picks: Column) -> Column:
                def swap(p: Column) -> Column:
                    return _letting(F.concat(text(p["i"], p["j"] - p["i"]), groups[p["j"]]), lambda old: F.struct(p["i"].alias("i"), p["j"].alias("j"), old.alias("old"), card(old, key).alias("new")))

                def joined(made: Column) -> Column:
                    def put(m: Column, k: Column) -> Column:
                        first = F.when(k == 0, 0).otherwise(F.get(made, k - 1)["j"] + 1)
                        return F.concat(text(first, m["i"] - first), m["new"], F.substring(spaced[m["j"]], F.length(groups[m["j"]]) + 1, F.lit(1)))

                    rest = F.when(F.size(made) == 0, 0).otherwise(F.get(made, F.size(made) - 1)["j"] + 1)
                    whole = F.array_join(F.concat(F.transform(made, put), F.array(text(rest, F.size(groups)))), "")
                    return F.struct(whole.alias("put"), F.transform(made, lambda m: F.struct(m["old"].alias("old"), m["new"].alias("new"))).alias("swaps"))

                return _letting(F.transform(picks, swap), joined)

            ends = F.transform(F.sequence(F.lit(0), F.size(groups) - 1), lambda i: _card_end(groups, i))
            return _letting(_letting(ends, _picked), chosen)

        return _letting(F.zip_with(groups, after, lambda g, a: F.concat(g, a)), pieces)

    return _letting(F.split(run, "[ -]"), of)


def phone(text: Column, key: str) -> Column:
    """Another number of the same country code. North American ones with area and exchange of 200 to 999 stay in the plan, all others of this form out of it."""
    return _letting(_digits(text), lambda d: F.when((F.length(d) == 10) | (F.length(d) == 11) & d.startswith("1"), _american(text, F.right(d, F.lit(10)), key)).otherwise(_abroad(text, d, key)))


def _abroad(text: Column, d: Column, key: str) -> Column:
    code = F.regexp_extract(d, "^(?:[17]|2[07]|3[0123469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})", 0)
    rest = F.substring(d, F.length(code) + 1, F.length(d))
    return _refill(text, F.concat(code, _halves(rest, F.concat(F.lit("phone "), code), key)))


def _american(text: Column, ten: Column, key: str) -> Column:
    d = F.concat(F.lit("1"), ten)
    area, exchange, line = _part(d, 2, 3), _part(d, 5, 3), _part(d, 8, 4)

    def filled(area: Column, exchange: Column, line: Column) -> Column:
        number = F.concat(_padded(area, 3), _padded(exchange, 3), _padded(line, 4))
        return _refill(text, F.when(F.length(_digits(text)) == 11, F.concat(F.lit("1"), number)).otherwise(number))

    def inside(moved: Column) -> Column:
        i = moved["l"] * 80_000 + moved["r"]
        rest = i % 8_000_000
        return filled(F.floor(i / 8_000_000) + 200, F.floor(rest / 10_000) + 200, rest % 10_000)

    def outside(moved: Column) -> Column:
        i = moved["l"] * 60_000 + moved["r"]
        pair = F.floor(i / 10_000)
        low = pair < 200_000
        area = F.when(low, F.floor(pair / 1000)).otherwise(F.floor((pair - 200_000) / 200) + 200)
        return filled(area, F.when(low, pair % 1000).otherwise((pair - 200_000) % 200), i % 10_000)

    planned = ((area - 200) * 800 + exchange - 200) * 10_000 + line
    # 200 areas with any exchange, then 800 areas with 200 exchanges.
    other = F.when(area < 200, area * 1000 + exchange).otherwise(200_000 + (area - 200) * 200 + exchange) * 10_000 + line
    new = _letting(feistel("phone", F.floor(planned / 80_000), planned % 80_000, (80_000, 80_000), key), inside)
    new_other = _letting(feistel("unplanned phone", F.floor(other / 60_000), other % 60_000, (60_000, 60_000), key), outside)
    return F.when((area >= 200) & (exchange >= 200), new).otherwise(new_other)


def ssn(text: Column, key: str) -> Column:
    """A social security number: area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999, each range kept. Others are never issued."""
    area, group, serial = _part(text, 1, 3), _part(text, 5, 2), _part(text, 8, 4)

    def put(moved: Column) -> Column:
        i = moved["r"]
        new_area = moved["l"] + F.when(moved["l"] < 665, 1).otherwise(2)
        return F.concat_ws("-", _padded(new_area, 3), _padded(F.floor(i / 9999) + 1, 2), _padded(i % 9999 + 1, 4))

    place = area - F.when(area < 666, 1).otherwise(2)
    new = _letting(feistel("ssn", place, (group - 1) * 9999 + serial - 1, (898, 99 * 9999), key), put)
    return F.when(area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1), new).otherwise(text)


def date(text: Column, key: str) -> Column:
    """A real day from 1800 to 2199, in figures or with an English month, which becomes another of these days in the same layout.

    Two short figures are month and day where slashes part them, else day and month, and the other way about only if
    that is no day; such days, all after the 12th, become days after the 12th, so that they are still read so.
    """
    n = F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))
    sep = F.regexp_extract(text, "[-/.]", 0)
    month_name = F.regexp_extract(text, f"(?i){_MONTH}", 0)
    first = F.lit(_FIRST_DAY).cast("date")

    def index(y: Column, m: Column, d: Column) -> Column:
        i = F.datediff(F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"), first)
        return F.when(i.between(0, _DAYS[0] * _DAYS[1] - 1), i.cast("long"))

    def other(i: Column) -> Column:
        return _letting(feistel("date", F.floor(i / _DAYS[1]), i % _DAYS[1], _DAYS, key), lambda x: x["l"] * _DAYS[1] + x["r"])

    def day(i: Column) -> Column:
        return F.date_add(first, i.cast("int"))

    def later(i: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(99)), i, lambda acc, k: F.when((k == 1) | (F.dayofmonth(day(acc)) < 13), other(acc)).otherwise(acc))

    def written(i: Column, *parts: str) -> Column:
        def put(on: Column) -> Column:
            long = F.concat_ws("|", *(F.date_format(on, p) for p in parts))
            return F.replace(F.when(F.length(text) == 10, long).otherwise(F.regexp_replace(long, r"\b0", "")), F.lit("|"), sep)

        return F.when(i.isNotNull(), _letting(day(i), put)).otherwise(text)

    def named(i: Column) -> Column:
        def put(on: Column) -> Column:
            full = F.date_format(on, "MMMM")
            name = F.when((F.length(month_name) > 4) | F.lower(month_name).isin("june", "july", "may"), full).otherwise(F.substring(full, 1, 3))
            name = F.when(month_name == F.upper(month_name), F.upper(name)).when(month_name == F.lower(month_name), F.lower(name)).otherwise(name)
            d = F.dayofmonth(on)
            nth = F.when(d.isin(1, 21, 31), "st").when(d.isin(2, 22), "nd").when(d.isin(3, 23), "rd").otherwise("th")
            nth = F.when(text.rlike("(?i)[0-9](?:st|nd|rd|th)"), nth).otherwise("")
            out = F.regexp_replace(text, F.lit("[0-9]{4}$"), F.date_format(on, "yyyy"))
            out = F.regexp_replace(out, F.lit("(?i)(?<![0-9])[0-9]{1,2}(?![0-9])(?:st|nd|rd|th)?"), F.concat(d.cast("string"), nth))
            return F.regexp_replace(out, F.lit(f"(?i){_MONTH}"), name)

        return F.when(i.isNotNull(), _letting(day(i), put)).otherwise(text)

    def short(usual: Column, turned: Column, *parts: str) -> Column:
        return F.when(usual.isNotNull(), written(other(usual), *parts)).otherwise(written(later(turned), parts[1], parts[0], parts[2]))

    months = "janfebmaraprmayjunjulaugsepoctnovdec"
    month = ((F.call_function("locate", F.lower(F.substring(month_name, 1, 3)), F.lit(months)) + 2) / 3).cast("int").cast("string")
    month_first, day_first = index(n[2], n[0], n[1]), index(n[2], n[1], n[0])
    out = F.when(text.rlike("^[0-9]{4}[-/.]"), written(other(index(n[0], n[1], n[2])), "yyyy", "MM", "dd"))
    out = out.when(month_name != "", named(other(index(n[1], month, n[0]))))
    return out.when(sep == "/", short(month_first, day_first, "MM", "dd", "yyyy")).otherwise(short(day_first, month_first, "dd", "MM", "yyyy"))


def ip(text: Column, key: str) -> Column:
    """An IPv4 address: its 32 bits are permuted."""
    octets = F.transform(F.split(text, r"\."), lambda o: o.cast("long"))

    def address(o: Column) -> Column:
        def put(moved: Column) -> Column:
            parts = [F.floor(moved["l"] / 256), moved["l"] % 256, F.floor(moved["r"] / 256), moved["r"] % 256]
            return F.concat_ws(".", *(p.cast("string") for p in parts))

        new = _letting(feistel("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], (65536, 65536), key), put)
        return F.when(F.forall(o, lambda x: x <= 255), new).otherwise(text)

    return _letting(octets, address)


def email(text: Column, key: str) -> Column:
    """Another mailbox at the same host: letters from a keyed hash of the lower-cased address."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(text)), 256)
    return F.concat(F.translate(F.substring(digest, 1, 16), "0123456789", "ghijklmnop"), F.lit("@"), F.substring_index(text, "@", -1))


def secret(text: Column, key: str) -> Column:
    """Hex digits of a keyed hash, as many as the secret has characters, up to 64."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("secret"), text), 256)
    return F.substring(digest, F.lit(1), F.length(text))


_KINDS = {"email": email, "secret": secret, "phone": phone, "ssn": ssn, "date": date, "card": card, "ip": ip}


def _kind(match: Column) -> Column:
    """Which kind a match of the joint pattern is."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(match.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return F.coalesce(out, F.lit("secret"))


def pseudonymise(docs: DataFrame, key: str, into: str = "pii") -> DataFrame:
    """The documents with personal data in their texts replaced, and a column `into`: an array of (kind, old, new).

    Card numbers with a right check digit, phone and social security numbers, IPv4 addresses and real dates become
    others of the same form by a keyed permutation, so equal values stay equal in all documents and different ones
    different; e-mail addresses and secrets get keyed hashes. What fails its check stays and isn't listed. Null
    texts stay null and empty ones empty, with an empty list. Texts are worked on whole, in time that grows with their length,
    and no pattern needs a deeper stack for a longer text. Repeated rows repeat. The key is the caller's to choose and to keep. Only the text changes; a column that is already named `into` is replaced.
    """
    joint = "|".join(PATTERNS.values())
    found = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(joint), F.lit(0))

    def whole(old: Column, new: Column, before: Column | None = None) -> Column:
        return F.struct((new if before is None else F.concat(before, new)).alias("put"), F.array(F.struct(old.alias("old"), new.alias("new"))).alias("swaps"))

    def replace(m: Column) -> Column:
        def hidden(before: Column) -> Column:
            return _letting(F.substring(m, F.length(before) + 1, F.length(m)), lambda old: whole(old, secret(old, key), before))

        def of_kind(k: Column) -> Column:
            made = F.when(k == "secret", _letting(F.regexp_extract(m, _BEFORE_SECRET, 0), hidden)).when(k == "card", _cards(m, key))
            new = m
            for kind, make in _KINDS.items():
                if kind not in ("secret", "card"):
                    new = F.when(k == kind, make(m, key)).otherwise(new)
            made = made.otherwise(_letting(new, lambda x: whole(m, x)))
            return _letting(made, lambda x: F.struct(x["put"].alias("put"), F.transform(x["swaps"], lambda s: F.struct(k.alias("kind"), s["old"].alias("old"), s["new"].alias("new"))).alias("swaps")))

        return _letting(_kind(m), of_kind)

    held = free_name(docs, "swaps")
    marked = docs.withColumn(held, F.transform(found, replace))
    news = F.concat(F.transform(held, lambda s: s["put"]), F.array(F.lit("")))
    gaps = F.split(F.col("text"), joint, -1)
    text = F.when(F.size(held) == 0, F.col("text")).otherwise(F.array_join(F.zip_with(gaps, news, lambda g, n: F.concat(g, n)), ""))
    listed = F.filter(F.flatten(F.transform(held, lambda s: s["swaps"])), lambda s: s["old"] != s["new"])
    return marked.withColumn("text", text).withColumn(into, listed).drop(held)


def redact(docs: DataFrame, key: str) -> DataFrame:
    """The documents with pseudonyms in their texts and n_chars, if there is one, following; no other column changes.

    Null and empty texts stay as they are, and so does n_chars where the text is null. Rows repeat as they did. Texts of any
    length are worked on whole, as by `pseudonymise`.
    """
    found = free_name(docs, "pii_found")
    out = pseudonymise(docs, key, found).drop(found)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
