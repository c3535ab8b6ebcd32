"""Personal data under format-preserving pseudonyms, in DataFrame functions only.

Card numbers, bank accounts (IBAN), social security numbers, telephone
numbers, IP addresses, dates and the local parts of e-mail addresses are looked
for, validated, and replaced by a keyed permutation within their own format: a
card number becomes another card number with the same separators and a right
check digit, a date another date of the calendar. The permutation is a Feistel
network whose round function is SHA-256 of the key, the kind, the round and the
other half, so equal values get equal pseudonyms in all documents, different
values different ones, and nobody without the key can undo them. Where a format
has invalid members the network is applied again until it yields a valid one
(cycle walking), which keeps it a permutation.

The formats are looked for one after the other, those with the strongest check
first. Each cuts what is left of the text at its candidates; those that validate
are replaced and set apart, those that do not stay part of the text, so that
later formats are found inside them. All else stays byte for byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.common import table

ROUNDS = 8
#: Most applications of the network to one value. An application misses the valid
#: values with probability 0.12 at most, so that this many never all miss.
WALKS = 40

#: Countries by the length of their IBANs (the registry's and those in use without an entry).
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}

#: Country calling codes of one and two digits; all others have three.
CALLING_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                 "81 82 84 86 90 91 92 93 94 95 98")


def _iban(length: int, countries: str) -> str:
    """Pattern of the IBANs of one length, written together or in groups of four."""
    groups, rest = divmod(length - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}"


#: Candidates in the order in which they are looked for; a kind is the name up to a blank.
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": rf"\b(?:{'|'.join(_iban(n, c) for n, c in IBAN_COUNTRIES.items())})\b",
    "iban of another code": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    # a run of up to 15 digits after '+' is a telephone number
    "card": r"(?<![0-9])(?:(?<!\+)[0-9]{13,15}|[0-9]{16,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}"
            r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?![0-9/-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    # '+' and 7 to 15 digits in groups of any length; a group in brackets may follow the country code
    "phone": r"(?<![0-9+])\+(?:" + "|".join(
        rf"[0-9]{{{c}}}[ .-]?\([0-9]{{{p}}}\)(?:[ ./-]?[0-9]){{{max(2, 7 - c - p)},{15 - c - p}}}"
        for c in (1, 2, 3) for p in (1, 2, 3, 4, 5)) + r"|[0-9](?:[ ./-]?[0-9]){6,14})(?![0-9])",
    # three, three and four digits
    "phone of ten digits": r"(?<![0-9+])(?:(?:\+?1[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
                           r"|(?:\+?1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])",
    # an area code that begins with 0, in brackets or not, and one or two groups; or five pairs
    "phone with 0": r"(?<![0-9+.,/-])(?<![0-9] )(?:0[1-9](?:([ .-])[0-9]{2})(?:\1[0-9]{2}){3}"
                    r"|(?:\(0[1-9][0-9]{0,4}\) ?|0[1-9][0-9]{0,4}(?: ?[/-] ?| ))(?:[0-9]{5,8}|[0-9]{3,4}[ -][0-9]{3,5}))"
                    r"(?![0-9])(?![.,/-][0-9])",
}

#: Days that dates are permuted among: 400 years, a whole cycle of the calendar.
FIRST_DAY, DAYS = "1800-01-01", 146097
#: The two halves of a day number are modulo this; its square is little more than DAYS.
DAY_HALF = 383


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _random(key: str, kind: str, round_: str, half: str, place: str = "0") -> str:
    """SQL for 48 bits of the round function."""
    return (f"cast(conv(substr(sha2(concat_ws('|', {_sql_text(key)}, '{kind}', {round_}, {place}, {half}), 256), 1, 12), "
            "16, 10) as bigint)")


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def permuted(key: str, kind: str, text: str) -> str:
    """SQL: a permutation of the strings whose letters (upper, lower) and digits stay in their
    classes at their places; other characters stay. Halves are moved in turn, each
    character by an amount that depends on the whole other half, case aside."""
    def moved(own: str, other: str) -> str:
        amount = _random(key, kind, "cast(r as string)", f"lower(array_join({other}, ''))", "cast(i as string)")
        return f"""transform({own}, (ch, i) -> CASE
            WHEN ch RLIKE '^[0-9]$' THEN char(48 + (ascii(ch) - 48 + {amount}) % 10)
            WHEN ch RLIKE '^[a-z]$' THEN char(97 + (ascii(ch) - 97 + {amount}) % 26)
            WHEN ch RLIKE '^[A-Z]$' THEN char(65 + (ascii(ch) - 65 + {amount}) % 26)
            ELSE ch END)"""
    halves = ("named_struct('a', slice(cs, 1, cast(floor(size(cs) / 2) as int)), "
              "'b', slice(cs, cast(floor(size(cs) / 2) as int) + 1, size(cs)))")
    network = f"""aggregate(sequence(1, {ROUNDS}), {halves}, (h, r) -> if(r % 2 = 1,
        named_struct('a', {moved('h.a', 'h.b')}, 'b', h.b), named_struct('a', h.a, 'b', {moved('h.b', 'h.a')})),
        h -> array_join(concat(h.a, h.b), ''))"""
    return _let("cs", f"split({text}, '')", network)


def _number(key: str, kind: str, value: str, first: int, second: int) -> str:
    """SQL: a permutation of 0 .. first * second - 1."""
    start = f"named_struct('a', cast(floor(n0 / {second}) as bigint), 'b', cast(n0 % {second} as bigint))"
    return _let("n0", value, f"""aggregate(sequence(1, {ROUNDS}), {start}, (h, r) -> if(r % 2 = 1,
        named_struct('a', (h.a + {_random(key, kind, 'cast(r as string)', 'cast(h.b as string)')}) % {first}, 'b', h.b),
        named_struct('a', h.a, 'b', (h.b + {_random(key, kind, 'cast(r as string)', 'cast(h.a as string)')}) % {second})),
        h -> h.a * {second} + h.b)""")


def _walked(value: str, again, valid) -> str:
    """SQL: ``again`` applied to ``value`` until ``valid``; both are SQL of the name they get."""
    first = "named_struct('x', y0, 'done', false)"
    return _let("y0", value, f"""aggregate(sequence(1, {WALKS}), {first}, (w, _) -> if(w.done, w,
        {_let('y', again('w.x'), f"named_struct('x', y, 'done', {valid('y')})")}), w -> w.x)""")


def _written(digits: str, value: str) -> str:
    """SQL: ``value`` with its digits replaced in turn by those of the string ``digits``."""
    return f"""aggregate(split({value}, ''), named_struct('out', '', 'i', 1), (o, ch) -> if(ch RLIKE '^[0-9]$',
        named_struct('out', concat(o.out, substr({digits}, o.i, 1)), 'i', o.i + 1),
        named_struct('out', concat(o.out, ch), 'i', o.i)), o -> o.out)"""


def _luhn(digits: str) -> str:
    """SQL: the Luhn sum modulo 10 of a digit string whose last place is the check digit."""
    return f"""aggregate(transform(split(reverse({digits}), ''), (ch, i) -> if(i % 2 = 0, cast(ch as int),
        cast(ch as int) * 2 - if(cast(ch as int) > 4, 9, 0))), 0, (s, x) -> s + x) % 10"""


def _mod97(text: str) -> str:
    """SQL: remainder by 97 of a string of digits and capitals (A = 10)."""
    return f"""aggregate(split({text}, ''), 0, (s, ch) -> if(ch RLIKE '^[0-9]$', (s * 10 + cast(ch as int)) % 97,
        (s * 100 + ascii(ch) - 55) % 97))"""


def _pseudonym(key: str, kind: str, v: str) -> tuple[str, str]:
    """SQL conditions and replacements of a candidate ``v``: (is valid, pseudonym)."""
    d = _digits(v)
    if kind == "email":
        local, domain = f"substring_index({v}, '@', 1)", f"substring_index({v}, '@', -1)"
        # one character has no two halves: it is moved by an amount that depends on the domain, and never by none
        amount = _random(key, kind, "'one'", f"lower({domain})")
        one = f"""CASE WHEN {local} RLIKE '^[0-9]$' THEN char(48 + (ascii({local}) - 47 + {amount} % 9) % 10)
            WHEN {local} RLIKE '^[a-z]$' THEN char(97 + (ascii({local}) - 96 + {amount} % 25) % 26)
            ELSE char(65 + (ascii({local}) - 64 + {amount} % 25) % 26) END"""
        return (f"{local} RLIKE '[A-Za-z0-9]'",
                f"concat(if(length({local}) > 1, {permuted(key, kind, local)}, {one}), '@', {domain})")
    if kind == "card":
        payload = f"substr({d}, 1, length({d}) - 1)"
        checked = _let("p", permuted(key, kind, payload), f"concat(p, cast((10 - {_luhn("concat(p, '0')")}) % 10 as string))")
        return (f"length({d}) BETWEEN 13 AND 19 AND {_luhn(d)} = 0 AND NOT {d} RLIKE '^0+$'",
                _let("ds", checked, _written("ds", v)))
    if kind == "iban":
        plain = f"replace({v}, ' ', '')"
        body = permuted(key, kind, f"substr({plain}, 5)")
        country = f"substr({v}, 1, 2)"
        check = f"lpad(cast(98 - {_mod97(f"concat(b, {country}, '00')")} as string), 2, '0')"
        spaced = ("aggregate(split(" + v + ", ''), named_struct('out', '', 'i', 1), (o, ch) -> if(ch = ' ', "
                  "named_struct('out', concat(o.out, ch), 'i', o.i), named_struct('out', concat(o.out, substr(f, o.i, 1)), "
                  "'i', o.i + 1)), o -> o.out)")
        return (f"length({plain}) BETWEEN 15 AND 34 AND {_mod97(f'concat(substr({plain}, 5), substr({plain}, 1, 4))')} = 1",
                _let("b", body, _let("f", f"concat({country}, {check}, b)", spaced)))
    if kind == "ssn":
        def valid(x: str) -> str:
            return f"NOT {x} RLIKE '^(000|666|9)' AND substr({x}, 4, 2) <> '00' AND substr({x}, 6) <> '0000'"
        return valid(d), _let("ds", _walked(d, lambda x: permuted(key, kind, x), valid), _written("ds", v))
    if kind == "phone":
        # the country code stays, what follows is permuted; both are told by the digits, so that a number
        # keeps its pseudonym however it is grouped. Eleven digits from 1 without '+' have a country code too.
        code = (f"CASE WHEN {v} LIKE '+%' THEN regexp_extract({d}, '^(?:{CALLING_CODES.replace(' ', '|')}|[0-9]{{3}})', 0) "
                f"WHEN length({d}) = 11 AND {d} LIKE '1%' THEN '1' ELSE '' END")
        return (f"length({d}) BETWEEN 7 AND 15",
                _let("code", code, _let("ds", f"concat(code, {permuted(key, kind, f'substr({d}, length(code) + 1)')})",
                                        _written("ds", v))))
    if kind == "ip":
        octets = f"transform(split({v}, '\\\\.'), x -> cast(x as bigint))"
        number = f"aggregate({octets}, 0L, (s, x) -> s * 256 + x)"
        written = _let("n", _number(key, kind, number, 65536, 65536),
                       "concat_ws('.', n div 16777216, (n div 65536) % 256, (n div 256) % 256, n % 256)")
        return f"forall({octets}, x -> x < 256)", written
    if kind == "date":
        year_first = f"{v} RLIKE '^[0-9]{{4}}'"
        parts = f"split({v}, '[-/.]')"
        # day before month if that can be told or nothing can; month first if the middle part is a day
        middle_is_day = f"(NOT {year_first} AND cast({parts}[1] as int) > 12)"
        day = (f"try_to_date(CASE WHEN {year_first} THEN concat_ws('-', {parts}[0], lpad({parts}[1], 2, '0'), lpad({parts}[2], 2, '0')) "
               f"WHEN {middle_is_day} THEN concat_ws('-', {parts}[2], lpad({parts}[0], 2, '0'), lpad({parts}[1], 2, '0')) "
               f"ELSE concat_ws('-', {parts}[2], lpad({parts}[1], 2, '0'), lpad({parts}[0], 2, '0')) END, 'yyyy-MM-dd')")
        number = f"cast(datediff({day}, date'{FIRST_DAY}') as bigint)"
        other = _walked(number, lambda x: _number(key, kind, x, DAY_HALF, DAY_HALF), lambda x: f"{x} < {DAYS}")
        mark = f"regexp_extract({v}, '[-/.]', 0)"
        # the pseudonym is written like the value: same order, same separators, two-place parts
        written = (f"CASE WHEN {year_first} THEN date_format(t, concat('yyyy', m, 'MM', m, 'dd')) "
                   f"WHEN {middle_is_day} THEN date_format(t, concat('MM', m, 'dd', m, 'yyyy')) "
                   f"ELSE date_format(t, concat('dd', m, 'MM', m, 'yyyy')) END")
        return (f"coalesce({number} BETWEEN 0 AND {DAYS - 1}, false)",
                _let("m", mark, _let("t", f"date_add(date'{FIRST_DAY}', cast({other} as int))", written)))
    raise ValueError(kind)


#: Stands before and after a value that is set apart. ``BAR`` of the text itself is
#: followed by ``OWN``, so that the text never holds a mark.
BAR, OWN = "\x01", "\x02"
MARK = BAR + "\x03"


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs(doc_id, text)`` with personal data under pseudonyms.

    One row per row: doc_id, n_values, kinds (of each value replaced, in the
    order of the text), pseudonyms, text. Null text stays null with 0 values;
    empty texts stay empty; rows without doc_id and repeated rows are treated
    like any other. Candidates that fail their check (Luhn, remainder of 97,
    calendar, octets, length) stay as they are, but for values of other kinds
    in them. Other columns are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # pieces of the text at even places; kind, a blank and the pseudonym at odd ones
    cut = F.when(F.col("text").rlike("[0-9@]"), F.replace("text", F.lit(BAR), F.lit(BAR + OWN)))
    rows = rows.withColumn("cut", cut)
    for name, pattern in FORMATS.items():
        rows = rows.withColumn("cut", F.expr(_replaced(key, name.split(" ")[0], pattern)))
    rows = rows.withColumn("cut", F.coalesce(F.split("cut", MARK, -1), F.expr("cast(array() as array<string>)")))
    rows = rows.withColumn("new", F.filter("cut", lambda _, i: i % 2 == 1))
    joined = F.array_join(F.transform("cut", lambda c, i: F.when(
        i % 2 == 1, F.regexp_replace(c, "^[a-z]+ ", "")).otherwise(F.replace(c, F.lit(BAR + OWN), F.lit(BAR)))), "")
    return rows.select("doc_id", F.size("new").cast("long").alias("n_values"),
                       F.transform("new", lambda n: F.substring_index(n, " ", 1)).alias("kinds"),
                       F.transform("new", lambda n: F.regexp_replace(n, "^[a-z]+ ", "")).alias("pseudonyms"),
                       F.when(F.size("new") > 0, joined).otherwise(F.col("text")).alias("text"))


def _replaced(key: str, kind: str, pattern: str) -> str:
    """SQL: ``cut`` with the valid candidates of one format in its pieces of text set apart."""
    valid, written = _pseudonym(key, kind, "v")
    mark = _sql_text(MARK)
    candidates = f"split(regexp_replace(s, {_sql_text(pattern)}, {_sql_text(MARK + '$0' + MARK)}), {mark}, -1)"
    own = (f"array_join(transform({candidates}, (v, j) -> CASE WHEN j % 2 = 1 AND {valid} "
           f"THEN concat({mark}, '{kind} ', {written}, {mark}) ELSE v END), '')")
    return f"array_join(transform(split(cut, {mark}, -1), (s, i) -> if(i % 2 = 1, s, {own})), {mark})"


#: Key of the registered query; a real run brings its own secret.
DEMONSTRATION_KEY = "a key of the tests"


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: see ``pseudonymised``."""
    return pseudonymised(table(spark, sf_dir, "documents"), DEMONSTRATION_KEY)
