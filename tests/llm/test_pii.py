import datetime
import hashlib
import random
import re

from faresight.llm import pii
from tests.llm import odd


def luhn(digits):
    d = [int(c) for c in digits if c.isdigit()][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def card(rng):
    body = "".join(rng.choice("0123456789") for _ in range(15))
    return next(body + c for c in "0123456789" if luhn(body + c))


def iban_ok(value):
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def iban(rng):
    body = "".join(rng.choice("0123456789") for _ in range(18))
    return next(v for v in (f"DE{c:02d}{body}" for c in range(2, 99)) if iban_ok(v))


def run(spark, values, key="k"):
    docs = spark.createDataFrame([(i, f"Zé {v} end.") for i, v in enumerate(values)], "doc_id long, text string")
    return [r.text[3:-5] for r in sorted(pii.pseudonymised(docs, key).collect(), key=lambda r: r.doc_id)]


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


def test_formats_stay_valid_and_differ(spark):
    rng = random.Random(1)
    cards, ibans = [card(rng) for _ in range(60)], [iban(rng) for _ in range(40)]
    ssns = ["123-45-6789", "899-99-9999", "001-01-0001"]
    ips = [f"{rng.randrange(256)}.{rng.randrange(256)}.0.{i}" for i in range(40)]
    phones = ["+1 (017) 555-7713", "(212) 555-0123", "212-555-0123", "+4930123456", "+44 20 7946 0958"]
    emails = ["ann.b07@mail.example.com", "Ann.B07@mail.example.com", "xy@ex.org"]
    days = [(datetime.date(1800, 1, 1) + datetime.timedelta(rng.randrange(pii.DAYS))).isoformat() for _ in range(60)]
    values = cards + ibans + ssns + ips + phones + emails + days
    got = dict(zip(values, run(spark, values)))
    for v in cards + ssns + phones + emails:
        assert shape(got[v]) == shape(v) and got[v] != v
    assert all(luhn(got[v]) for v in cards) and all(iban_ok(got[v]) and got[v][:2] == "DE" for v in ibans)
    assert all(not re.match("000|666|9", got[v]) and got[v][4:6] != "00" and got[v][7:] != "0000" for v in ssns)
    assert all(all(0 <= int(x) < 256 for x in got[v].split(".")) for v in ips)
    assert all(1800 <= datetime.date.fromisoformat(got[v]).year < 2200 for v in days)
    for group in (cards, ibans, ips, set(days)):
        assert len({got[v] for v in group}) == len(set(group))
    assert got[emails[0]].lower() == got[emails[1]].lower() and got[emails[1]][0].isupper()
    other = dict(zip(values, run(spark, values, "another key")))
    assert sum(got[v] != other[v] for v in values) > 0.95 * len(values)


def test_equal_values_stay_linked_and_separators_stay(spark):
    a, b, c, d = run(spark, ["4539148803436467", "4539 1488 0343 6467", "4539-1488-0343-6467", "call 4539148803436467 4111111111111111"])
    assert a == b.replace(" ", "") == c.replace("-", "") and shape(b) == "9999 9999 9999 9999"
    assert d.split()[1] == a


def test_permutation_of_a_whole_small_domain(spark):
    """Every two-digit string under the string network, every number under the number network."""
    from pyspark.sql import functions as F
    words = spark.range(100).select(F.expr(pii.permuted("k", "t", "lpad(cast(id as string), 2, '0')")).alias("x"))
    assert sorted(r.x for r in words.collect()) == [f"{i:02d}" for i in range(100)]
    numbers = spark.range(35).select(F.expr(pii._number("k", "t", "id", 5, 7)).alias("x"))
    assert sorted(r.x for r in numbers.collect()) == list(range(35))


def test_invalid_values_and_clean_texts_stay(spark):
    values = ["4539148803436468", "300.1.1.1", "1.2.3", "2023-02-29", "31/02/2020", "000-12-3456", "DE89370400440532013001",
              "12.12.", "section 1.2.3.4.5", "100000", "0000000000000000", "a@b", "price 12,50", "x=1-2-3"]
    assert run(spark, values) == values


def test_odd_rows(spark):
    got = pii.pseudonymised(odd.documents(spark), "k").collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(r[0]), str(r[1])) for r in odd.ROWS)
    assert all(r.n_values == 0 == len(r.kinds) == len(r.pseudonyms) for r in got)
    assert pii.pseudonymised(odd.nothing(spark), "k").count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.pseudonymised(odd.documents(spark), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_ibans_before_capitals_and_digits(spark):
    """An IBAN ends at its country's length, whatever follows; a failed one hides no other value."""
    ibans = ["BE68539007547034", "ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "LT121000011101001000",
             "SE45 5000 0000 0583 9825 7466", "PL61109010140000071219812874"]
    tails = ["EUR", "2024", "A1", "X"]
    texts = [f"{v} {tail}" for v in ibans for tail in tails]
    for text, got in zip(texts, run(spark, texts)):
        value, tail = text.rsplit(" ", 1)
        new, rest = got.rsplit(" ", 1)
        assert rest == tail and new != value and iban_ok(new) and shape(new) == shape(value) and new[:2] == value[:2]
    alone = run(spark, ibans)
    assert [g.rsplit(" ", 1)[0] for g in run(spark, [f"{v} EUR" for v in ibans])] == alone
    number = "4539 1488 0343 6467"
    new = run(spark, [number])[0]
    hidden = [f"AB12 {number}", f"DE12 {number} 12"]
    assert run(spark, hidden) == [v.replace(number, new) for v in hidden] and new != number


def test_texts_with_the_marks_of_the_module(spark):
    marks = [pii.MARK, pii.BAR, pii.OWN, pii.BAR + pii.OWN, pii.MARK + "card 1" + pii.MARK]
    ip = run(spark, ["10.0.0.7"])[0]
    assert run(spark, [f"{m} 10.0.0.7 {m}" for m in marks]) == [f"{m} {ip} {m}" for m in marks]


def test_telephone_numbers_in_groups_of_any_length(spark):
    phones = ["+49 171 1234567", "+49 30 123456", "+44 7700 900123", "+33 1 23 45 67 89", "555 123 4567", "+1 555 123 4567",
              "+49 (0)30 123456", "+49 (0) 171 1234567", "+49-171-1234567", "+358.9.1234567", "+4930123456", "+8613812345678",
              "020 7946 0958", "0171 1234567", "030/123456", "(030) 123456", "01 23 45 67 89", "07700 900123"]
    got = run(spark, phones)
    for v, new in zip(phones, got):
        assert shape(new) == shape(v) and new != v
        assert not v.startswith("+") or new[:2] == v[:2]
    assert all(new.startswith(v.split(" ")[0] + " ") for v, new in zip(phones, got) if re.match(r"\+[0-9]+ ", v))
    # what follows in words, dates and separate short numbers is no part of the number
    assert run(spark, [f"({v}), 7 days" for v in phones[:6]]) == [f"({new}), 7 days" for new in got[:6]]


def test_numbers_that_are_no_telephone_numbers_stay(spark):
    values = ["+49 30 12", "1 000 000 000", "0.12 345678", "10 000 12345", "4539 0148 0343 6468", "2023-02-29", "02/30/2020",
              "31-02-2020", "55 123 4567", "1234 5678"]
    assert run(spark, values) == values


def test_cards_after_a_hyphen_and_short_local_parts(spark):
    number = "4539148803436467"
    new, after = run(spark, [number, f"ref-{number}"])
    assert after == f"ref-{new}" and luhn(new) and new != number
    mails = ["j@example.org", "J@example.org", "7@example.org"] + [f"{c}@ex.org" for c in "abcdefghijklmnopqrstuvwxyz"]
    got = run(spark, mails)
    assert all(shape(g) == shape(m) and g[0] != m[0] and g[1:] == m[1:] for g, m in zip(got, mails))
    assert got[0] == got[1].lower() and len(set(got[3:])) == 26
    assert run(spark, ["_@example.org"]) == ["_@example.org"]


def plain_permuted(key, kind, text, rounds=8):
    """The Feistel network of digit strings, by itself."""
    def moved(own, other, r):
        return "".join(str((int(c) + int(hashlib.sha256(f"{key}|{kind}|{r}|{i}|{other}".encode()).hexdigest()[:12], 16)) % 10)
                       for i, c in enumerate(own))
    a, b = text[:len(text) // 2], text[len(text) // 2:]
    for r in range(1, rounds + 1):
        a, b = (moved(a, b, r), b) if r % 2 else (a, moved(b, a, r))
    return a + b


def digits(value):
    return re.sub("[^0-9]", "", value)


def test_a_telephone_number_keeps_its_pseudonym_however_it_is_grouped(spark):
    alike = [("49", ["+49 171 1234567", "+491711234567", "+49-171-123-4567", "+49 (171) 1234567", "+4 9171 1234567"]),
             ("358", ["+358 9 1234567", "+35891234567", "+358.9.1234567"]),
             ("1", ["+1 555 123 4567", "+15551234567", "1-555-123-4567", "+1 (555) 123-4567", "(555) 123-4567",
                    "555-123-4567", "555 123 4567"]),
             ("7", ["+7 495 123 45 67", "+74951234567"]), ("44", ["+44 20 7946 0958", "+442079460958"]),
             ("998", ["+998 71 123 45 67", "+998711234567"])]
    values = [v for _, group in alike for v in group]
    got = dict(zip(values, run(spark, values)))
    for code, group in alike:
        for v in group:
            has_code = v.startswith("+") or len(digits(v)) == 11
            own = digits(v)[len(code):] if has_code else digits(v)
            assert digits(got[v]) == (code if has_code else "") + plain_permuted("k", "phone", own)
            assert shape(got[v]) == shape(v) and got[v] != v


def test_telephone_numbers_of_a_country_are_permuted_among_themselves(spark):
    values = [f"+423 {n:04d}" for n in range(0, 10000, 5)]
    got = run(spark, values)
    assert len(set(got)) == len(values) and all(re.fullmatch(r"\+423 [0-9]{4}", v) for v in got)


def test_card_payloads_against_a_plain_network(spark):
    rng = random.Random(7)
    cards = [card(rng) for _ in range(30)]
    for v, new in zip(cards, run(spark, cards)):
        assert new[:-1] == plain_permuted("k", "card", v[:-1]) and luhn(new)
