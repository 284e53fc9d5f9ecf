"""Pseudonyms against a plain version of the same networks, value by value."""

import hashlib
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from airmart.llm import pseudonyms as P, queries

SIGNS = "0123456789abcdefghijklmnopqrstuvwxyz"


def noise(key, kind, size, i, part):
    return int(hashlib.sha256(f"{key}|{kind}|{size}|{i}|{part}".encode()).hexdigest()[:15], 16)


def network(left, right, n_left, n_right, key, kind):
    size = f"{n_left}x{n_right}"
    for i in range(1, 11):
        if i % 2:
            left = (left + noise(key, kind, size, i, right) % n_left) % n_left
        else:
            right = (right + noise(key, kind, size, i, left) % n_right) % n_right
    return left, right


def digits(d, key, kind):
    cut = len(d) // 2
    left, right = network(int(d[:cut]), int(d[cut:]), 10**cut, 10 ** (len(d) - cut), key, kind)
    return f"{left:0{cut}d}{right:0{len(d) - cut}d}"


def luhn(d, doubled_last):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if (i % 2 == 0) == doubled_last else 1)
        total += x - 9 if x > 9 else x
    return total


def respelled(text, cls, new):
    signs = iter(new)
    return re.sub(cls, lambda m: next(signs), text)


def card(v, key):
    d = re.sub(r"\D", "", v)
    if luhn(d, False) % 10 == 0:
        body = d[0] + digits(d[1:-1], key, "card")
        return respelled(v, r"\d", body + str(-luhn(body, True) % 10))
    return card(v[:19], key) + v[19:] if len(v) == 23 else v


def a_date(v, year_first, key):
    try:
        y, m, d = (int(x) for x in ((v[:4], v[5:7], v[8:]) if year_first else (v[6:], v[3:5], v[:2])))
        index = (date(y, m, d) - date(1800, 1, 1)).days
    except ValueError:
        return v
    mark, other = (v[4], v[7]) if year_first else (v[2], v[5])
    if mark != other or not 0 <= index < 146097:
        return v
    left, right = network(index // 773, index % 773, 189, 773, key, "date")
    new = date(1800, 1, 1) + timedelta(days=left * 773 + right)
    return f"{new.year:04d}{mark}{new.month:02d}{mark}{new.day:02d}" if year_first else f"{new.day:02d}{mark}{new.month:02d}{mark}{new.year:04d}"


def social(v, key):
    area, group, serial = map(int, v.split("-"))
    if not (1 <= area <= 899 and area != 666 and group and serial):
        return v
    left, right = network((area - (2 if area > 666 else 1)) * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")
    index = left // 99
    return f"{index + (2 if index >= 665 else 1):03d}-{left % 99 + 1:02d}-{right + 1:04d}"


def address(v, key):
    a, b, c, d = map(int, v.split("."))
    if max(a, b, c, d) > 255:
        return v
    left, right = network(a * 256 + b, c * 256 + d, 65536, 65536, key, "ip")
    return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"


def base36(n, size):
    out = ""
    for _ in range(size):
        out, n = SIGNS[n % 36] + out, n // 36
    return out


def email(v, key):
    local, rest = v.split("@", 1)
    signs, new = re.sub("[^A-Za-z0-9]", "", local).lower(), ""
    for k in range(0, len(signs), 20):
        part = signs[k : k + 20]
        if len(part) == 1:
            new += base36((int(part, 36) + noise(key, "sign", 1, 0, 0) % 36) % 36, 1)
        else:
            cut = len(part) // 2
            left, right = network(int(part[:cut], 36), int(part[cut:], 36), 36**cut, 36 ** (len(part) - cut), key, "email")
            new += base36(left, cut) + base36(right, len(part) - cut)
    return respelled(local, "[A-Za-z0-9]", new) + "@" + rest


def phone(v, key):
    d = re.sub(r"\D", "", v)
    return respelled(v, r"\d", d[:-10] + digits(d[-10:], key, "phone")) if 10 <= len(d) <= 15 else v


def pseudonym(v, key):
    whole = lambda p: re.fullmatch(p, v, re.ASCII)
    if "@" in v:
        return email(v, key)
    if whole(P.ISO_DATE):
        return a_date(v, True, key)
    if whole(P.DAY_DATE):
        return a_date(v, False, key)
    if whole(P.SSN):
        return social(v, key)
    if whole(P.IP):
        return address(v, key)
    if whole(P.PHONE) and not whole(r"\d+"):
        return phone(v, key)
    return card(v, key) if whole(P.CARD) else v


def brute(text, key):
    return None if text is None else re.sub(P.FOUND, lambda m: pseudonym(m.group(), key), text, flags=re.ASCII)


def test_all_documents_agree_with_brute_force(spark, sf01):
    rows = {r.doc_id: r.text for r in queries.table(spark, sf01, "documents").collect()}
    got = {r.doc_id: (r.changed, r.text) for r in queries.op7_pseudonyms(spark, sf01).collect()}
    want = {i: brute(t, queries.KEY) for i, t in rows.items()}
    assert got == {i: (want[i] != t, want[i]) for i, t in rows.items()} and sum(c for c, _ in got.values()) > 10


ODD = [
    None, "", "3056 930902 5904", "born 2024-01-15T10:30 or 2024-01-15, not 2024-13-45", "010.1.1.1 10.1.1.1 300.1.1.1", "12/25/2024 25/12/2024",
    "4111 1111 1111 1111 123", "4111-1111-1111-1111", "3782 822463 10005", "6304 0000 0000 0000 000", "4222 2222 2222 2", "5 4111111111111111 7", "a@b.co A.b+c@x-y.org",
    "1@2.de", "666-12-1234 123-45-6789", "+49 170 1234567 (212) 555-0123", "x" * 50_000 + " 10.0.0.1", "4111111111111112",
]


def test_odd_values_agree_with_brute_force(spark):
    rows = list(enumerate([*ODD, *ODD]))
    df = spark.createDataFrame(rows, "i int, t string").withColumn("key", F.lit("own")).repartition(3)
    got = {r.i: (r.t, r.key) for r in queries.with_pseudonyms(df, "t").collect()}
    assert got == {i: (brute(t, queries.KEY), "own") for i, t in rows}
    changed = {t for t in ODD if t and brute(t, "k") != t}
    assert {"3056 930902 5904", "4111 1111 1111 1111 123", "3782 822463 10005"} <= changed and "4111111111111112" not in changed
    assert brute("2024-01-15T10:30", "k")[10:] == "T10:30" and brute("2024-01-15T10:30", "k")[:10] != "2024-01-15"
    assert queries.with_pseudonyms(df.limit(0), "t").count() == 0


def test_no_plan_holds_the_key(spark, sf001):
    found = queries.op7_pseudonyms(spark, sf001)
    found.count()
    plan = found._jdf.queryExecution().toString()
    assert queries.KEY not in plan and "Subquery" in plan
    with pytest.raises(Exception, match="a key is needed"):
        keyed = spark.range(1).withColumn("own", P.stored_key(spark, P.store_key(spark, "  ")))
        keyed.select(P.pseudonymise(F.lit("10.0.0.1"), F.col("own"))).collect()
