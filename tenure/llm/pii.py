"""Format-preserving pseudonyms for personal data, as DataFrame expressions.

Candidates come from one regular expression and are then validated: card
numbers by their check digit, IBANs by their remainder, dates by the calendar,
IPv4 addresses and social security numbers by their ranges, phone numbers by
their digit count. A valid value is replaced by its image under a keyed
Feistel permutation of its own format, so equal values stay equal in all
documents, different ones stay different, and the image is valid again.

* letters and digits (cards, IBANs, phones, the local part of e-mail
  addresses): each round shifts one half, character by character within its
  class (digit, lower, upper), by a keyed hash of the other half;
* dates, addresses and social security numbers: the value is a pair of numbers
  from Z_a x Z_b, and rounds add keyed hashes modulo a and b in turn. Dates from
  1801 to 2200 are one calendar cycle of 146,097 = 189 x 773 days.

Candidates are looked for at every place. Where one fails, the other kinds at
the same place, for IBANs their shorter forms (the length of the country, any
length for countries not listed), and all places after it are tried; the first
valid value from the left wins. Only phone numbers, which have no check of their
own, are not looked for inside a candidate that failed, or every number with a
wrong check digit would be taken for one.

Check digits are computed anew. Country codes of phones and IBANs and the
domains of e-mail addresses stay. A local part of one character is permuted by
the rank of its keyed hash among its class, since a shift of one would give
all the others away. Everything runs in the JVM as one map over
the input. Text without a valid value stays.

The keyed hash is SHA-256 nested under two keys derived from the secret one. The
secret is read from a file by a scalar subquery: it is in no plan, explain
output, event log or column. That file must be as closed as the texts.

Defined results: null text stays null and has count 0; empty text stays empty;
repeated rows get equal rows; an empty table gives an empty table; other
columns are not read. ``dd/mm/yyyy`` is read day first, month first if only
that is a date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.session import new_run_folder

ROUNDS = 8
# Kinds in the order in which candidates are tried.
KINDS = ("email", "iban", "ipv4", "date", "ssn", "card", "phone")

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# Phone numbers in groups of two with one separator, all of them or only the last two.
_PAIRS = (
    r"|\+[0-9]{{1,3}}[ .-]?(?:\(0\)[ .-]?)?(?:[0-9]{{1,3}}{s})?[0-9]{{2}}(?:{s}[0-9]{{2}}){{2,3}}(?![0-9])"
    r"|(?:\([0-9]{{2,5}}\)[ .-]?|(?<![0-9])(?:0[0-9]{{1,4}}|[0-9]{{3}}){s})[0-9]{{2}}(?:{s}[0-9]{{2}}){{2,3}}(?![0-9])"
    r"|(?<![0-9])[0-9]{{2}}(?:{s}[0-9]{{2}}){{3,4}}(?![0-9])"
    r"|(?:\+[0-9]{{1,3}}[ .-]?(?:\(0\)[ .-]?)?)?(?:\([0-9]{{2,5}}\)|(?<![0-9])[0-9]{{2,4}})[ .-]?[0-9]{{3}}{s}[0-9]{{2}}{s}[0-9]{{2}}(?![0-9])"
)
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv4": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9])(?!\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![A-Za-z0-9])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|(?<![0-9])[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|\+[0-9]{8,15}(?![0-9])"
    + "".join(_PAIRS.format(s=sep) for sep in (" ", "[.]", "-")),
}
#: Texts without any of these hold no candidate and skip the full pattern.
HINT = "[0-9@]"
#: Characters from a candidate's start that hold any candidate but an e-mail address, and what its pattern looks at behind it.
WINDOW = 64
#: Starts that are settled in one go; bounds the copying in texts with very many.
RUN = 256
# IBAN lengths by country, from the registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


#: The inner and the outer key of the nested hash.
Key = tuple[Column, Column]


def store_key(spark: SparkSession, secret: str) -> str:
    """Write a secret key to a file in the shared work folder; returns its folder."""
    folder = new_run_folder(spark, "key")
    spark.createDataFrame([(secret,)], "value string").coalesce(1).write.text(folder)
    return folder


def read_key(spark: SparkSession, key_file: str) -> Key:
    """The two keys as scalar subqueries over the file's only line; no line is an error."""
    line = F.coalesce(F.min("value"), F.raise_error(F.lit("the key file is empty")).cast("string"))
    lines = spark.read.text(key_file).where("value != ''")
    return tuple(lines.agg(F.sha2(F.concat(F.lit(side + "|"), line), 256).alias(side)).scalar() for side in ("inner", "outer"))


def _hex(key: Key, *parts: Column) -> Column:
    inner = F.sha2(F.concat(key[0], F.lit("|"), F.concat_ws("|", *parts)), 256)
    return F.sha2(F.concat(key[1], F.lit("|"), inner), 256)


def _number(hex_: Column, start: Column | int = 1, digits: int = 12) -> Column:
    return F.conv(F.substr(hex_, F.lit(start) if isinstance(start, int) else start, F.lit(digits)), 16, 10).cast("bigint")


def _chars(text: Column) -> Column:
    """Characters as an array (empty for the empty text)."""
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: lambda variables are the names that expressions have."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shift(half: Column, hex_: Column) -> Column:
    def move(c: Column, i: Column) -> Column:
        by = _number(hex_, (i % 16) * 4 + 1, 4)
        code = F.ascii(c)

        def turned(base: int, size: int) -> Column:
            return F.char(F.lit(base) + (code - base + by) % size)

        return F.when(c.between("0", "9"), turned(48, 10)).when(c.between("a", "z"), turned(97, 26)).when(c.between("A", "Z"), turned(65, 26)).otherwise(c)

    return F.array_join(F.transform(_chars(half), move), "")


def permute_text(value: Column, key: Key, tweak: Column) -> Column:
    """Feistel permutation of the texts that have this value's length and character classes."""
    def turn(s: Column, r: Column) -> Column:
        return _bind(_hex(key, tweak, r.cast("string"), s["b"]), lambda h: F.struct(s["b"].alias("a"), _shift(s["a"], h).alias("b")))

    def halves(v: Column) -> Column:
        h = F.floor(F.length(v) / 2).cast("int")
        return F.struct(F.substr(v, F.lit(1), h).alias("a"), F.substr(v, h + 1, F.length(v)).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), _bind(value, halves), turn, lambda s: F.concat(s["a"], s["b"]))


def permute_one(value: Column, key: Key, tweak: Column) -> Column:
    """Permutation of one character within its class, by the rank of its keyed hash."""
    def ranked(base: int, size: int) -> Column:
        every = F.array(*[F.lit(chr(base + k)) for k in range(size)])
        below = _bind(_hex(key, tweak, F.lit("one"), value), lambda own: F.size(F.filter(every, lambda c: _hex(key, tweak, F.lit("one"), c) < own)))
        return F.char(F.lit(base) + below)

    return F.when(value.between("0", "9"), ranked(48, 10)).when(value.between("a", "z"), ranked(97, 26)).when(value.between("A", "Z"), ranked(65, 26)).otherwise(value)


def permute_pair(left: Column, right: Column, a: int, b: int, key: Key, tweak: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the image (l, r) under a Feistel permutation of Z_a x Z_b."""
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def turn(s: Column, k: Column) -> Column:
        new = (s["l"] + _number(_hex(key, tweak, k.cast("string"), F.lit("l"), s["r"].cast("string")))) % a
        return _bind(new, lambda n: F.struct(n.alias("l"), ((s["r"] + _number(_hex(key, tweak, k.cast("string"), F.lit("r"), n.cast("string")))) % b).alias("r")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, use)


def _only(value: Column, classes: str) -> Column:
    return F.regexp_replace(value, f"[^{classes}]", "")


def _refill(shape: Column, filling: Column, classes: str) -> Column:
    """``shape`` with its characters of ``classes`` replaced, in order, by those of ``filling``."""
    def refilled(f: Column) -> Column:
        at = F.transform(_chars(shape), lambda c, i: F.when(c.rlike(f"[{classes}]"), F.substr(f, F.length(_only(F.substr(shape, F.lit(1), i + 1), classes)), F.lit(1))).otherwise(c))
        return F.array_join(at, "")

    return _bind(filling, refilled)


def _luhn(digits: Column) -> Column:
    """Sum that is a multiple of ten for a valid number; the last digit counts once."""
    def part(c: Column, i: Column) -> Column:
        d = F.ascii(c) - 48
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.reverse(_chars(digits)), part), F.lit(0), lambda total, x: total + x)


def _mod97(text: Column) -> Column:
    """Remainder of an IBAN-like text (letters are 10 to 35) by 97."""
    def add(r: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (r * 10 + F.ascii(c) - 48) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(_chars(text), F.lit(0), add)


def _card_valid(x: Column) -> Column:
    return _luhn(_only(x, "0-9")) % 10 == 0


def _card(x: Column, key: Key) -> Column:
    def image(body: Column) -> Column:
        check = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
        return _refill(x, F.concat(body, check.cast("string")), "0-9")

    return _bind(_only(x, "0-9"), lambda d: _bind(permute_text(F.substr(d, F.lit(1), F.length(d) - 1), key, F.lit("card")), image))


def _iban_valid(x: Column) -> Column:
    flat = _only(x, "A-Z0-9")
    return F.length(flat).between(15, 34) & (_mod97(F.concat(F.substr(flat, F.lit(5), F.length(flat)), F.substr(flat, F.lit(1), F.lit(4)))) == 1)


def _iban(x: Column, key: Key) -> Column:
    def image(flat: Column) -> Column:
        country = F.substr(flat, F.lit(1), F.lit(2))

        def filled(body: Column) -> Column:
            check = F.lpad((98 - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
            return _refill(x, F.concat(country, check, body), "A-Z0-9")

        return _bind(permute_text(F.substr(flat, F.lit(5), F.length(flat)), key, F.concat(F.lit("iban"), country)), filled)

    return _bind(_only(x, "A-Z0-9"), image)


def _phone_valid(x: Column) -> Column:
    return F.length(_only(x, "0-9")).between(8, 15)


def _phone(x: Column, key: Key) -> Column:
    digits = _only(x, "0-9")
    code = F.regexp_extract(x, r"^\+([0-9]{1,3})(?=[ .(-])", 1)
    code = F.when(code != "", code).when(x.startswith("+"), F.substr(digits, F.lit(1), F.lit(1))).otherwise("")

    def image(c: Column) -> Column:
        rest = permute_text(F.substr(digits, F.length(c) + 1, F.length(digits)), key, F.concat(F.lit("phone"), c))
        return _refill(x, F.concat(c, rest), "0-9")

    return _bind(code, image)


def _ipv4(x: Column, key: Key) -> Column:
    def shown(p: Column) -> Column:
        parts = [F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256]
        return F.concat_ws(".", *[v.cast("string") for v in parts])

    o = F.transform(F.split(x, "[.]"), lambda v: v.cast("int"))
    return _bind(o, lambda o: permute_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, F.lit("ipv4"), shown))


def _ssn_parts(x: Column) -> list[Column]:
    return [F.substr(x, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (5, 2), (8, 4))]


def _ssn_valid(x: Column) -> Column:
    area, group, serial = _ssn_parts(x)
    return area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)


def _ssn(x: Column, key: Key) -> Column:
    def shown(p: Column) -> Column:
        index = F.floor(p["l"] / 99)
        area = index + F.when(index >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad((p["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((p["r"] + 1).cast("string"), 4, "0"))

    area, group, serial = _ssn_parts(x)
    index = area - F.when(area > 666, 2).otherwise(1)  # 898 areas
    return permute_pair(index * 99 + group - 1, serial - 1, 898 * 99, 9999, key, F.lit("ssn"), shown)


def _calendar(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a date's parts: iso, year, month and day if day first, both possible orders checked."""
    iso = F.substr(x, F.lit(5), F.lit(1)) == "-"
    n = F.split(x, "[-/.]")
    parts = F.struct(
        iso.alias("iso"), F.when(iso, n[0]).otherwise(n[2]).cast("int").alias("year"),
        n[1].cast("int").alias("one"), F.when(iso, n[2]).otherwise(n[0]).cast("int").alias("two"),
    )

    def checked(d: Column) -> Column:
        leap = (d["year"] % 4 == 0) & ((d["year"] % 100 != 0) | (d["year"] % 400 == 0))

        def real(month: Column, day: Column) -> Column:
            days = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
            return d["year"].between(1801, 2200) & month.between(1, 12) & (day >= 1) & (day <= days)

        straight = real(d["one"], d["two"])
        return F.struct(d.alias("d"), straight.alias("straight"), (~d["iso"] & ~straight & real(d["two"], d["one"])).alias("swapped"))

    return _bind(_bind(parts, checked), use)


def _date_valid(x: Column) -> Column:
    return _calendar(x, lambda c: c["straight"] | c["swapped"])


def _date(x: Column, key: Key) -> Column:
    first = F.lit("1801-01-01").cast("date")
    mark = F.substr(x, F.lit(3), F.lit(1))

    def image(c: Column) -> Column:
        d, swapped = c["d"], c["swapped"]
        month, day = F.when(swapped, d["two"]).otherwise(d["one"]), F.when(swapped, d["one"]).otherwise(d["two"])
        at = F.datediff(F.make_date(d["year"], month, day), first)

        def shown(p: Column) -> Column:
            def text(new: Column) -> Column:
                fmt = lambda f: F.date_format(new, f)
                usual = F.concat(fmt("dd"), mark, fmt("MM"), mark, fmt("yyyy"))
                return F.when(d["iso"], fmt("yyyy-MM-dd")).when(swapped, F.concat_ws("/", fmt("MM"), fmt("dd"), fmt("yyyy"))).otherwise(usual)

            return _bind(F.date_add(first, (p["l"] * 773 + p["r"]).cast("int")), text)

        return _bind(at, lambda at: permute_pair(F.floor(at / 773), at % 773, 189, 773, key, F.lit("date"), shown))

    return _calendar(x, image)


def _email(x: Column, key: Key) -> Column:
    local, domain = F.substring_index(x, "@", 1), F.substring_index(x, "@", -1)
    tweak = F.concat(F.lit("email"), F.lower(domain))
    image = F.when(F.length(local) == 1, permute_one(local, key, tweak)).otherwise(permute_text(local, key, tweak))
    return F.concat(image, F.lit("@"), domain)


_VALID = {"iban": _iban_valid, "date": _date_valid, "ssn": _ssn_valid, "card": _card_valid, "phone": _phone_valid}
_IMAGES = {"email": _email, "iban": _iban, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def _iban_forms(whole: Column) -> Column:
    """What may be the IBAN at the start of its longest match: all of it, or its words up to the country's length."""
    words, country = F.split(whole, " "), F.substr(whole, F.lit(1), F.lit(2))
    size = F.lit(None).cast("int")
    for n, countries in IBAN_LENGTHS.items():
        size = F.when(country.isin(countries.split()), n).otherwise(size)

    def shorter(n: Column) -> Column:
        heads = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(words, 1, k), " "))
        exact = F.filter(heads, lambda x: F.length(_only(x, "A-Z0-9")) == n)
        return F.concat(exact, F.when(n.isNull(), heads).otherwise(F.array(whole)))

    return _bind(size, shorter)


def _valid_at(context: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of the first valid value after the first character (kind and value, or null) and of the length of what failed instead of it."""
    def tried(name: str) -> Column:
        def forms(whole: Column) -> Column:
            every = _iban_forms(whole) if name == "iban" else F.array(whole)
            valid = F.get(F.filter(every, _VALID[name]), F.lit(0)) if name in _VALID else whole
            return F.struct(F.lit(name).alias("kind"), F.when(whole != "", valid).alias("value"), F.length(whole).alias("size"))

        return _bind(F.regexp_extract(context, r"^[\s\S](" + PATTERNS[name] + ")", 1), forms)

    def chosen(every: Column) -> Column:
        best = F.get(F.filter(every, lambda x: x["value"].isNotNull()), F.lit(0))
        lost = F.array_max(F.transform(every, lambda x: F.when(x["value"].isNull(), x["size"]).otherwise(0)))
        return use(best, F.when(best["kind"] != "phone", 0).otherwise(lost))

    return _bind(F.array(*map(tried, KINDS)), chosen)


def _settled(starts: Column) -> Column:
    """For every start: the kind replaced there (or null) and how many characters of its part belong to replaced values.

    ``starts`` have kind, value, failed and ``part``, the number of characters up to the next start.
    """
    flags = "array<struct<kind:string,cut:int>>"

    def step(s: Column, x: Column) -> Column:
        free = s["skip"] == 0
        barred = F.when(free & (s["barred"] == 0), x["failed"]).otherwise(s["barred"])
        take = free & x["kind"].isNotNull() & ((x["kind"] != "phone") | (barred == 0))
        cut = F.when(take, F.length(x["value"])).otherwise(s["skip"])
        flag = F.struct(F.when(take, x["kind"]).alias("kind"), cut.alias("cut"))
        left = lambda n: F.greatest(n - x["part"], F.lit(0))
        return F.struct(left(cut).alias("skip"), left(barred).alias("barred"), F.concat(s["flags"], F.array(flag)).cast(flags).alias("flags"))

    def run(s: Column, k: Column) -> Column:
        begin = F.struct(s["skip"].alias("skip"), s["barred"].alias("barred"), F.array().cast(flags).alias("flags"))
        one = F.aggregate(F.slice(starts, k * RUN + 1, F.lit(RUN)), begin, step)
        return _bind(one, lambda r: F.struct(r["skip"].alias("skip"), r["barred"].alias("barred"), F.concat(s["runs"], F.array(r["flags"])).cast(f"array<{flags}>").alias("runs")))

    begin = F.struct(F.lit(0).alias("skip"), F.lit(0).alias("barred"), F.array().cast(f"array<{flags}>").alias("runs"))
    runs = F.sequence(F.lit(0), F.floor((F.size(starts) - 1) / RUN).cast("int"))
    return F.aggregate(runs, begin, run, lambda s: F.flatten(s["runs"]))


def pseudonymised(docs: DataFrame, secret: str | None = None, id_col: str = "doc_id", text_col: str = "text", key_file: str | None = None) -> DataFrame:
    """doc_id, text with pseudonyms, the number replaced of each kind, and their total.

    ``key_file`` is a text file (or folder of one) with the secret key; a key
    given as ``secret`` is first written to such a file in the work folder.
    """
    if (secret is None) == (key_file is None):
        raise ValueError("give either the secret key or the file that holds it")
    spark = docs.sparkSession
    inner, outer = read_key(spark, key_file or store_key(spark, secret))
    key = F.col("inner_key"), F.col("outer_key")
    other = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS if k != "email")
    # matches nothing, but stands before every place where a candidate begins, and sees what follows
    start = rf"(?=({PATTERNS['email']}|(?={other})[\s\S]{{1,{WINDOW}}}))"
    text = F.col("text")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.withColumns({"inner_key": inner, "outer_key": outer})
    # a line feed in front, so that something stands before each candidate
    rows = rows.withColumn("led", F.when(text.rlike(HINT), F.concat(F.lit("\n"), text)))
    rows = rows.withColumn("ahead", F.regexp_extract_all("led", F.lit(start), F.lit(1)))
    some = F.size("ahead") > 0
    rows = rows.withColumn("parts", F.when(some, F.split("led", start, -1)))

    def at(x: Column, i: Column) -> Column:
        def found(best: Column, failed: Column) -> Column:
            return F.struct(best["kind"].alias("kind"), best["value"].alias("value"), failed.alias("failed"), F.length(F.get("parts", i + 1)).alias("part"))

        return _valid_at(F.concat(F.right(F.get("parts", i), F.lit(1)), x), found)

    rows = rows.withColumn("starts", F.when(some, F.transform("ahead", at)))
    rows = rows.withColumn("flags", F.when(some, _settled(F.col("starts"))))

    def image(x: Column, kind: Column) -> Column:
        out = F.lit("")
        for name in KINDS:
            out = F.when(kind == name, _IMAGES[name](x, key)).otherwise(out)
        return out

    def shown(x: Column, i: Column) -> Column:
        part = F.get("parts", i + 1)
        return _bind(F.get("flags", i), lambda f: F.concat(image(x["value"], f["kind"]), F.substr(part, f["cut"] + 1, F.length(part))))

    new = F.concat(F.substr(F.get("parts", F.lit(0)), F.lit(2)), F.array_join(F.transform("starts", shown), ""))

    def count(name: str) -> Column:
        return F.when(some, F.size(F.filter("flags", lambda f: f["kind"] == name))).otherwise(0).cast("long").alias("n_" + name)

    counts = [count(name) for name in KINDS]
    out = rows.select("doc_id", F.coalesce(new, text).alias("text"), *counts)
    return out.withColumn("n_replaced", sum((F.col("n_" + k) for k in KINDS), F.lit(0).cast("long")))
