"""Format-preserving pseudonyms for personal data, in SQL functions only.

Personal values are found by one pattern, validated, and permuted by a keyed
Feistel network within their format, so that an equal value becomes an equal
pseudonym in every document and spelling, and the key can turn it back
(`reveal=True`):

| Kind | Validated by | Permuted |
|---|---|---|
| e-mail | pattern | letters and digits of the local part, over 36 signs; other signs and the domain stay |
| card | 13 to 19 digits, together or in the groups in use, Luhn sum | all digits but the first and last; the last is the new check digit |
| phone | 10 to 15 digits with + or separators | the last 10 digits |
| IPv4 | four numbers up to 255 | all 32 bits |
| social security number | ddd-dd-dddd, parts that are issued | within all issued numbers |
| date | exists in the calendar, 1800 to 2199; yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, dd/mm/yyyy | within these 146,097 days |

A network of 10 rounds alternates between two parts of a value, adding to one a
SHA-256 of key, kind, size, round and the other part. What fails its validation
stays as it is. Null texts stay null, empty ones empty; rows, repeated rows and
other columns are untouched. A null or empty key is an error. Left alone: dates with the
month first (12/25/2024), addresses with leading zeros, card numbers in other groups.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from airmart.session import scratch_path

ROUNDS = 10
SIGNS = "0123456789abcdefghijklmnopqrstuvwxyz"
DAYS = (189, 773)  # their product is the number of days in 400 years
FIRST_DAY = "1800-01-01"

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+\-]*@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"
ISO_DATE = r"\d{4}[-/]\d{2}[-/]\d{2}"
DAY_DATE = r"\d{2}[./]\d{2}[./]\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
OCTET = r"(?:0|[1-9]\d{0,2})"
IP = rf"{OCTET}(?:\.{OCTET}){{3}}"
CARD = r"\d(?:[ \-]?\d){12,18}"
# How cards of 13 to 19 digits are written in groups; 19 digits hold 16 at their beginning.
GROUPS = r"\d{4}(?:[ \-]\d{4}){3}(?:[ \-]\d{3})?|\d{4}[ \-]\d{6}[ \-]\d{4,5}|\d{4}[ \-]\d{5}[ \-]\d{6}|\d{5}[ \-]\d{5}[ \-]\d{5}|\d{6}[ \-]\d{8}(?:\d{5})?|\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d|\d{4}[ \-]\d{4}[ \-]\d{5}"
PHONE = r"\+?\d{0,3}[ .\-]?(?:\(\d{3}\)|\d{3})[ .\-]\d{3}[ .\-]?\d{4}|\+\d{1,3}(?:[ .\-]?\d){7,12}"
# A value stands alone: no letter, digit or joining sign touches it, but a date may be followed by T and a time.
FOUND = rf"(?<![\w@])(?:{EMAIL}|{ISO_DATE}(?=T\d)|(?:{ISO_DATE}|{DAY_DATE}|{SSN}|{IP}|{PHONE}|\d{{13,19}}|{GROUPS})(?![\w]))"


def noise(key: Column, kind: str, size: Column, round_: Column, part: Column) -> Column:
    """A keyed number of 60 bits."""
    text = F.concat_ws("|", key, F.lit(kind), size.cast("string"), round_.cast("string"), part.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def permuted(left: Column, right: Column, n_left: Column, n_right: Column, key: Column, kind: str, reveal: bool) -> Column:
    """Struct (l, r): the pair permuted among all pairs below (n_left, n_right)."""
    sign = -1 if reveal else 1
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    size = F.concat_ws("x", n_left.cast("string"), n_right.cast("string"))

    def one(pair: Column, i: Column) -> Column:
        by_right = F.pmod(pair.l + sign * F.pmod(noise(key, kind, size, i, pair.r), n_left), n_left)
        by_left = F.pmod(pair.r + sign * F.pmod(noise(key, kind, size, i, pair.l), n_right), n_right)
        odd = i % 2 == 1
        return F.struct(F.when(odd, by_right).otherwise(pair.l).alias("l"), F.when(odd, pair.r).otherwise(by_left).alias("r"))

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if reveal else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, one)


def with_value(value: Column, then) -> Column:
    """Computes `value` once and hands it to `then`, as an expression would repeat it wherever it is named."""
    return F.transform(F.array(value), then)[0]


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def power(base: int, n: Column) -> Column:
    return F.round(F.pow(F.lit(float(base)), n)).cast("long")


def permuted_digits(digits: Column, key: Column, kind: str, reveal: bool) -> Column:
    """Digits of one length (2 to 34) permuted among all of that length."""
    cut = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - cut
    left, right = F.substr(digits, F.lit(1), cut), F.substr(digits, cut + 1, rest)
    pair = permuted(left.cast("long"), right.cast("long"), power(10, cut), power(10, rest), key, kind, reveal)
    return with_value(pair, lambda p: F.concat(F.lpad(p.l.cast("string"), cut, "0"), F.lpad(p.r.cast("string"), rest, "0")))


def respelled(text: Column, signs: str, new: Column) -> Column:
    """Text whose characters of a class (a pattern) are replaced in order by those of `new`."""
    def spell(letters: Column) -> Column:
        done = F.aggregate(
            F.split(text, r"(?!^)(?!\z)"), F.struct(F.lit("").alias("text"), F.lit(0).alias("n")),
            lambda acc, c: F.when(c.rlike(signs), F.struct(F.concat(acc.text, F.substr(letters, acc.n + 1, F.lit(1))).alias("text"), (acc.n + 1).alias("n")))
            .otherwise(F.struct(F.concat(acc.text, c).alias("text"), acc.n.alias("n"))),
        )
        return done.text

    return with_value(new, spell)


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Sum of digits, every second one doubled, from the right."""
    signs = F.reverse(F.split(digits, r"(?!^)(?!\z)"))
    parts = F.transform(signs, lambda c, i: F.when((i % 2 == 0) == F.lit(doubled_last), F.element_at(F.array(*(F.lit(2 * k - 9 if k > 4 else 2 * k) for k in range(10))), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b)


def card(text: Column, key: Column, reveal: bool) -> Column:
    """A valid number; where 19 digits in groups are none, the 16 at their beginning may be one."""
    def body(digits: Column) -> Column:
        inner = permuted_digits(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card", reveal)
        made = with_value(F.concat(F.substr(digits, F.lit(1), F.lit(1)), inner), lambda d: F.concat(d, F.pmod(10 - luhn_sum(d, True) % 10, F.lit(10)).cast("string")))
        return made

    def whole(part: Column, otherwise: Column) -> Column:
        return with_value(digits_of(part), lambda d: F.when(luhn_sum(d, False) % 10 == 0, respelled(part, r"\d", body(d))).otherwise(otherwise))

    head, tail = F.substr(text, F.lit(1), F.lit(19)), F.substr(text, F.lit(20), F.lit(4))
    shorter = F.when(F.length(text) == 23, F.concat(whole(head, head), tail)).otherwise(text)
    return whole(text, shorter)


def phone(text: Column, key: Column, reveal: bool) -> Column:
    def body(digits: Column) -> Column:
        own = F.length(digits)
        made = F.concat(F.substr(digits, F.lit(1), own - 10), permuted_digits(F.substr(digits, own - 9, F.lit(10)), key, "phone", reveal))
        return F.when(own.between(10, 15), respelled(text, r"\d", made)).otherwise(text)

    return with_value(digits_of(text), body)


def address(text: Column, key: Column, reveal: bool) -> Column:
    def body(parts: Column) -> Column:
        pair = permuted(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65536), F.lit(65536), key, "ip", reveal)
        made = with_value(pair, lambda p: F.concat_ws(".", *(x.cast("string") for x in (F.floor(p.l / 256), p.l % 256, F.floor(p.r / 256), p.r % 256))))
        return F.when(F.forall(parts, lambda x: x < 256), made).otherwise(text)

    return with_value(F.transform(F.split(text, r"\."), lambda x: x.cast("long")), body)


def social(text: Column, key: Column, reveal: bool) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""
    def body(parts: Column) -> Column:
        area = parts[0] - F.when(parts[0] > 666, 2).otherwise(1)
        pair = permuted(area * 99 + parts[1] - 1, parts[2] - 1, F.lit(898 * 99), F.lit(9999), key, "ssn", reveal)

        def spell(p: Column) -> Column:
            index = F.floor(p.l / 99)
            return F.concat_ws("-", F.lpad((index + F.when(index >= 665, 2).otherwise(1)).cast("string"), 3, "0"), F.lpad((p.l % 99 + 1).cast("string"), 2, "0"), F.lpad((p.r + 1).cast("string"), 4, "0"))

        issued = parts[0].between(1, 899) & (parts[0] != 666) & (parts[1] > 0) & (parts[2] > 0)
        return F.when(issued, with_value(pair, spell)).otherwise(text)

    return with_value(F.transform(F.split(text, "-"), lambda x: x.cast("long")), body)


def date(text: Column, year_first: bool, key: Column, reveal: bool) -> Column:
    mark = F.substr(text, F.lit(5 if year_first else 3), F.lit(1))
    other = F.substr(text, F.lit(8 if year_first else 6), F.lit(1))
    digits = digits_of(text)
    read = F.try_to_timestamp(digits, F.lit("yyyyMMdd" if year_first else "ddMMyyyy")).cast("date")

    def body(day: Column) -> Column:
        index = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        pair = permuted(F.floor(index / DAYS[1]), index % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, "date", reveal)
        made = with_value(pair, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p.l * DAYS[1] + p.r).cast("int")))
        shape = ("yyyy", "MM", "dd") if year_first else ("dd", "MM", "yyyy")
        spelled = with_value(made, lambda d: F.concat_ws("", F.date_format(d, shape[0]), mark, F.date_format(d, shape[1]), mark, F.date_format(d, shape[2])))
        return F.when((mark == other) & index.between(0, DAYS[0] * DAYS[1] - 1), spelled).otherwise(text)

    return with_value(read, body)


def email(text: Column, key: Column, reveal: bool) -> Column:
    """Signs of the local part in lower case; one sign alone is added to, longer parts are permuted 20 signs at a time."""
    at = F.instr(text, "@")
    local = F.substr(text, F.lit(1), at - 1)
    signs = F.lower(F.regexp_replace(local, "[^A-Za-z0-9]", ""))

    def value(part: Column) -> Column:
        return F.aggregate(F.split(part, r"(?!^)(?!\z)"), F.lit(0).cast("long"), lambda a, c: a * 36 + F.instr(F.lit(SIGNS), c) - 1)

    def spell(number: Column, size: Column) -> Column:
        done = F.aggregate(
            F.sequence(F.lit(1), size), F.struct(F.lit("").alias("text"), number.alias("rest")),
            lambda acc, _: F.struct(F.concat(F.substr(F.lit(SIGNS), (acc.rest % 36 + 1).cast("int"), F.lit(1)), acc.text).alias("text"), F.floor(acc.rest / 36).cast("long").alias("rest")),
        )
        return done.text

    def made(part: Column) -> Column:
        size = F.length(part)
        cut = F.floor(size / 2).cast("int")
        left, right = F.substr(part, F.lit(1), cut), F.substr(part, cut + 1, size - cut)
        n_left, n_right = power(36, cut), power(36, size - cut)
        pair = permuted(value(left), value(right), n_left, n_right, key, "email", reveal)
        alone = F.pmod(value(part) + (-1 if reveal else 1) * F.pmod(noise(key, "sign", size, F.lit(0), F.lit(0)), F.lit(36)), F.lit(36))
        return F.when(size == 1, spell(alone, size)).otherwise(with_value(pair, lambda p: F.concat(spell(p.l, cut), spell(p.r, size - cut))))

    def body(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(own), F.lit(20))
        new = F.array_join(F.transform(starts, lambda i: with_value(F.substr(own, i, F.lit(20)), made)), "")
        return F.concat(respelled(local, "[A-Za-z0-9]", new), F.substr(text, at, F.length(text)))

    return with_value(signs, body)


def pseudonym(value: Column, key: Column, reveal: bool = False) -> Column:
    """The pseudonym of one found value, or the value itself if it is not valid."""
    return (
        F.when(F.contains(value, F.lit("@")), email(value, key, reveal))
        .when(value.rlike(f"^(?:{ISO_DATE})$"), date(value, True, key, reveal))
        .when(value.rlike(f"^(?:{DAY_DATE})$"), date(value, False, key, reveal))
        .when(value.rlike(f"^(?:{SSN})$"), social(value, key, reveal))
        .when(value.rlike(f"^(?:{IP})$"), address(value, key, reveal))
        .when(value.rlike(f"^(?:{PHONE})$") & ~value.rlike(r"^\d+$"), phone(value, key, reveal))
        .when(value.rlike(f"^(?:{CARD})$"), card(value, key, reveal))
        .otherwise(value)
    )


def pseudonymise(texts: str | Column, key: str | Column, reveal: bool = False) -> Column:
    """Each text with every valid personal value replaced by its pseudonym.

    A key given as text is part of the plan, and so of event logs; where these may not
    hold it, add `stored_key` to the table as a column and name that.
    """
    if isinstance(key, str) and not key:
        raise ValueError("a key is needed")
    text = F.col(texts) if isinstance(texts, str) else texts
    pattern, secret = F.lit(FOUND), F.lit(key) if isinstance(key, str) else key
    values = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda v: pseudonym(v, secret, reveal))
    # The texts between the values, one more than there are values.
    between = F.split(text, FOUND, -1)
    joined = F.array_join(F.transform(between, lambda part, i: F.concat(part, F.coalesce(F.get(values, i), F.lit("")))), "")
    return F.when(text.rlike("[0-9@]"), joined).otherwise(text)


def store_key(spark: SparkSession, key: str) -> str:
    """Writes a key to a new file in the shared scratch folder and returns its path; a real key lies in a file of its own already."""
    path = scratch_path(spark, "key")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path, False)
    out.write(bytearray(key, "utf-8"))
    out.close()
    return path


def stored_key(spark: SparkSession, path: str) -> Column:
    """The key that a file of one line holds, read while a query runs: plans have its path only. An absent or empty key is an error."""
    key = F.trim(F.max("value"))
    missing = F.raise_error(F.lit("a key is needed")).cast("string")
    return spark.read.text(path).agg(F.when(F.length(key) > 0, key).otherwise(missing).alias("key")).scalar()


def values_found(texts: str | Column) -> Column:
    """All values in the order of the text that the pattern finds, valid or not."""
    return F.regexp_extract_all(texts, F.lit(FOUND), F.lit(0))
