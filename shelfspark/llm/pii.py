"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

One pattern finds candidates; each is validated by its own rule (Luhn digit,
IBAN check digits, calendar, octets, number ranges) and, if valid, replaced by
the image of a keyed permutation of its format's domain. The permutation is a
Feistel network over two halves (a, b) with moduli (A, B): eight rounds of
adding a keyed hash of one half to the other, which is a bijection of the A * B
values, whatever A and B are. So a card number becomes another card number with
a right check digit, a date another date, and equal values of a kind get equal
pseudonyms in all documents, in any notation.

  card    13 to 19 digits with a right Luhn digit: the digits before it are
          permuted, the digit is recomputed, separators stay
  iban    right check digits: the account's digits are permuted, the country
          stays, the check digits are recomputed
  ssn     valid area, group and serial: permuted among the valid ones
  phone   the digits after the country code are permuted, the notation stays
  ip      four octets, permuted among all addresses
  date    yyyy-mm-dd, dd.mm.yyyy or mm/dd/yyyy of the 400 years from 1700 to 2099
          (146,097 = 189 * 773 days), permuted among these
  secret  32 and more hexadecimal digits, permuted in blocks of 24 with the block's number in the hash, case kept
  email   names and domains have no numeric format; each gets a keyed name,
          equal domains stay equal

The key is the session setting ``spark.shelfspark.pii.key``; without it only local
masters (tests) run, with a key that is no secret.

Defined cases: null texts stay null, empty ones empty; candidates that fail
their rule stay as they are; of overlapping candidates the leftmost counts, at
one place the kind named first in ``PATTERNS``; repeated rows get equal texts;
an empty table gives no rows; all other columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
KEY_CONF = "spark.shelfspark.pii.key"
#: Of local sessions that set none: known to all, so what it makes can be turned back by anyone.
TEST_KEY = "shelfspark"

# A domain ends at its last label that starts with two letters. Java repeats a group without recursing
# only if it is possessive; otherwise a domain of some thousand labels overflows the stack and ends the executor.
_LABEL = r"[\p{L}\p{N}-]++"
_OTHER_LABELS = rf"(?:\.(?!\p{{L}}{{2}}){_LABEL})*+"
_DOMAIN = (rf"{_LABEL}(?:{_OTHER_LABELS}\.(?=\p{{L}}{{2}}){_LABEL}(?={_OTHER_LABELS}\.\p{{L}}{{2}}))*+"
           rf"{_OTHER_LABELS}\.\p{{L}}{{2,24}}")
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@" + _DOMAIN,
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])[0-9a-fA-F]{32,}+(?![\p{L}\p{N}])",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "date": r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": (r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
              r"|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}([.-])\d{3}\1\d{4}(?![\d-])"),
    "card": r"(?<![\d])(?:\d{13,19}|\d{4}([ -])\d{4}\2\d{4}\2\d{4}|\d{4}([ -])\d{6}\3\d{5})(?!\d)",
}
ANY = "|".join(PATTERNS.values())


def key_of(spark: SparkSession) -> str:
    """The session's secret key; a cluster must set one."""
    key = spark.conf.get(KEY_CONF, None)
    if key:
        return key
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{KEY_CONF} must hold a secret key")
    return TEST_KEY


def _hash(key: str, kind: str | Column, turn: Column, value: Column) -> Column:
    """48 keyed bits."""
    text = F.concat_ws("|", F.lit(key), kind if isinstance(kind, Column) else F.lit(kind), turn.cast("string"), value.cast("string"), F.lit(key))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, kind: str | Column) -> Column:
    """Struct (a, b): the image of (a, b) in [0, size_a) x [0, size_b)."""
    def turn(s, i):
        return F.when(i % 2 == 0, F.struct(
            F.pmod(s["a"] + F.pmod(_hash(key, kind, i, s["b"]), size_a), size_a).alias("a"), s["b"].alias("b"))
        ).otherwise(F.struct(
            s["a"].alias("a"), F.pmod(s["b"] + F.pmod(_hash(key, kind, i, s["a"]), size_b), size_b).alias("b")))
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once (a one-element array gives it a name)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _part(text: Column, start, length) -> Column:
    return F.substring(text, start, length)


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """The image of a string of 2 to 30 decimal digits among the strings of its length."""
    def image(d):
        n = F.length(d)
        u = F.floor(n / 2).cast("int")
        size = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")  # noqa: E731  10 to the k
        a, b = _part(d, F.lit(1), u).cast("long"), _part(d, u + 1, n - u).cast("long")
        return _with(feistel(a, b, size(u), size(n - u), key, kind), lambda s: F.concat(
            F.lpad(s["a"].cast("string"), u, "0"), F.lpad(s["b"].cast("string"), n - u, "0")))
    return _with(digits, image)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def filled(template: Column, digits: Column) -> Column:
    """``template`` with its decimal digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("out"))

    def put(s, c):
        is_digit = c.between("0", "9")
        return F.struct((s["i"] + is_digit.cast("int")).alias("i"), F.concat(
            s["out"], F.when(is_digit, _part(digits, s["i"] + 1, F.lit(1))).otherwise(c)).alias("out"))
    return F.aggregate(F.split(template, ""), start, put, lambda s: s["out"])


def luhn_sum(digits: Column, shift: int) -> Column:
    """Luhn's sum; ``shift`` 0: the last digit counts once, 1: it counts double."""
    def add(s, c):
        d = c.cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return F.struct((s["t"] + F.when(s["i"] % 2 == 1, twice).otherwise(d)).alias("t"), (s["i"] + 1).alias("i"))
    start = F.struct(F.lit(0).alias("t"), F.lit(shift).alias("i"))
    return F.aggregate(F.split(F.reverse(digits), ""), start, add, lambda s: s["t"])


def _card(m: Column, key: str) -> Column:
    def image(d):
        def closed(p):
            return F.concat(p, F.pmod(10 - luhn_sum(p, 1) % 10, F.lit(10)).cast("string"))
        new = _with(permuted_digits(_part(d, F.lit(1), F.length(d) - 1), key, "card"), closed)
        return F.when(luhn_sum(d, 0) % 10 == 0, _with(new, lambda x: filled(m, x))).otherwise(m)
    return _with(_digits(m), image)


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a text of digits and capitals (A counts 10)."""
    def add(r, c):
        v = F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (r * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(m: Column, key: str) -> Column:
    compact = F.regexp_replace(m, " ", "")

    def of(t):
        n = F.length(t)
        country, account = _part(t, F.lit(1), F.lit(2)), _part(t, F.lit(5), n - 4)
        valid = n.between(15, 34) & (_mod97(F.concat(account, _part(t, F.lit(1), F.lit(4)))) == 1) & (
            F.length(_digits(account)).between(2, 30))

        def rebuilt(new):  # the account with its new digits
            check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
            return _with(F.concat(check, _digits(new)), lambda x: filled(m, x))
        new = _with(permuted_digits(_digits(account), key, "iban"), lambda d: filled(account, d))
        return F.when(valid, _with(new, rebuilt)).otherwise(m)
    return _with(compact, of)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (_part(m, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - 1 - (area > 666).cast("int")  # 0 to 897

    def text(s):
        i = F.floor(s["a"] / 99)
        number = i + 1 + (i >= 665).cast("int")
        return F.concat_ws("-", F.lpad(number.cast("string"), 3, "0"),
                           F.lpad((s["a"] % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((s["b"] + 1).cast("string"), 4, "0"))
    image = feistel(index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")
    return F.when(valid, _with(image, text)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    code = F.length(F.regexp_extract(m, r"^\+(\d{1,3})[ .(-]", 1))
    keep = F.when(code > 0, code).when(m.startswith("+"), 1).otherwise(0)

    def image(d):
        rest = F.length(d) - keep
        new = F.concat(_part(d, F.lit(1), keep), permuted_digits(_part(d, keep + 1, rest), key, "phone"))
        return F.when(F.length(d).between(7, 15) & (rest >= 4), _with(new, lambda x: filled(m, x))).otherwise(m)
    return _with(_digits(m), image)


def _ip(m: Column, key: str) -> Column:
    def image(p):
        o = [p[i].cast("int") for i in range(4)]
        valid = (o[0] < 256) & (o[1] < 256) & (o[2] < 256) & (o[3] < 256)
        text = lambda s: F.concat_ws(".", *[
            x.cast("string") for x in (F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256)])
        size = F.lit(65536)
        return F.when(valid, _with(feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], size, size, key, "ip"),
                                   text)).otherwise(m)
    return _with(F.split(m, r"\."), image)


FIRST_DAY, YEARS_400 = "1700-01-01", 146097


def _date(m: Column, key: str) -> Column:
    layout = (F.when(_part(m, F.lit(5), F.lit(1)) == "-", "yyyy-MM-dd")
              .when(_part(m, F.lit(3), F.lit(1)) == ".", "dd.MM.yyyy").otherwise("MM/dd/yyyy"))
    iso = (F.when(layout == "yyyy-MM-dd", m)
           .when(layout == "dd.MM.yyyy", F.regexp_replace(m, r"(\d\d)\.(\d\d)\.(\d{4})", "$3-$2-$1"))
           .otherwise(F.regexp_replace(m, r"(\d\d)/(\d\d)/(\d{4})", "$3-$1-$2")))

    def image(n):
        def text(s):
            day = F.date_add(F.lit(FIRST_DAY).cast("date"), (s["a"] * 189 + s["b"]).cast("int")).cast("string")
            return (F.when(layout == "yyyy-MM-dd", day)
                    .when(layout == "dd.MM.yyyy", F.regexp_replace(day, r"(\d{4})-(\d\d)-(\d\d)", "$3.$2.$1"))
                    .otherwise(F.regexp_replace(day, r"(\d{4})-(\d\d)-(\d\d)", "$2/$3/$1")))
        return F.when(n.between(0, YEARS_400 - 1), _with(
            feistel(F.floor(n / 189), n % 189, F.lit(773), F.lit(189), key, "date"), text)).otherwise(m)
    return _with(F.datediff(F.try_to_date(iso, "yyyy-MM-dd") if hasattr(F, "try_to_date")
                            else iso.try_cast("date"), F.lit(FIRST_DAY).cast("date")), image)


def _secret(m: Column, key: str) -> Column:
    """Blocks of up to 24 hexadecimal digits, each permuted with its place as a tweak."""
    upper = m == F.upper(m)
    low = F.lower(m)
    starts = F.sequence(F.lit(0), F.floor((F.length(m) - 1) / 24).cast("int"))

    def block(i):
        part = _part(low, i * 24 + 1, F.lit(24))

        def image(p):
            n = F.length(p)
            u = F.floor(n / 2).cast("int")
            size = lambda k: F.conv(F.rpad(F.lit("1"), k + 1, "0"), 16, 10).cast("long")
            half = lambda start, k: F.coalesce(F.conv(_part(p, start, k), 16, 10).cast("long"), F.lit(0))
            text = lambda x, k: F.when(k > 0, F.lpad(F.lower(F.conv(x.cast("string"), 10, 16)), k, "0")).otherwise("")
            return _with(feistel(half(F.lit(1), u), half(u + 1, n - u), size(u), size(n - u), key,
                                 F.concat(F.lit("secret "), i.cast("string"))),
                         lambda s: F.concat(text(s["a"], u), text(s["b"], n - u)))
        return _with(part, image)
    new = F.array_join(F.transform(starts, block), "")
    return F.when(upper, F.upper(new)).otherwise(new)


def _email(m: Column, key: str) -> Column:
    name = lambda kind, x, n: F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lower(x), F.lit(key)), 256), 1, n)  # noqa: E731,E501
    domain = F.substring_index(m, "@", -1)
    return F.concat(F.lit("p"), name("email", m, 14), F.lit("@d"), name("domain", domain, 10), F.lit(".example"))


REPLACE = {"email": _email, "iban": _iban, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn,
           "phone": _phone, "card": _card}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a text that ``ANY`` matches."""
    whole = {k: f"^(?:{p})$" for k, p in PATTERNS.items()}
    # alone, each pattern counts its groups from 1
    whole["card"] = whole["card"].replace(r"\2", r"\1").replace(r"\3", r"\2")
    out = value
    for kind in reversed(PATTERNS):
        out = F.when(value.rlike(whole[kind]), REPLACE[kind](value, key)).otherwise(out)
    return out


def pseudonymised(text: Column, key: str) -> Column:
    """``text`` with its personal data replaced."""
    between = F.split(text, ANY, -1)
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    new = F.transform(found, lambda m: pseudonym(m, key))
    joined = F.array_join(F.zip_with(between, new, lambda b, n: F.concat(b, F.coalesce(n, F.lit("")))), "")
    # cheap test first: most texts hold neither digits nor an @
    return F.when(text.rlike(r"@|\d{2}|\d\.\d|[0-9a-fA-F]{32}"), joined).otherwise(text)


def pseudonymise(docs: DataFrame, key: str | None = None, column: str = "text") -> DataFrame:
    """``docs`` with ``column`` pseudonymised; all else is passed on."""
    return docs.withColumn(column, pseudonymised(F.col(column), key or key_of(docs.sparkSession)))
