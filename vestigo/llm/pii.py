"""Format-preserving Feistel pseudonyms for validated personal numbers, dates and addresses.

Found values are checked first (Luhn for cards, octets for IPv4, the calendar for
dates, the numbering plan's shape for phones and social security numbers) and
only valid ones change. Each is a number in a domain of its format; an unbalanced
Feistel network keyed by SHA-256 permutes that domain, so a value always gets the
same pseudonym, different values get different ones, and the key turns them back.
Punctuation and letter case stay in place:

=======  ==================================================================
card     13 to 19 digits that pass Luhn: all but the last are permuted, the
         check digit is computed anew. In a run of numbers parted by single
         spaces or hyphens every span of whole numbers is tried: usual card
         groupings first, then from the left, the longest first
phone    +country, then ten digits grouped 3-3-4: the ten digits are permuted;
         without a country, (ddd) ddd-dddd, ddd-ddd-dddd and ddd.ddd.dddd where
         area and exchange begin with 2 to 9. Those and numbers of country 1 are
         permuted alike: valid ones among the valid, others among the others
ipv4     the 32-bit address is permuted
ssn      3-2-4 digits in the issued ranges: permuted among those
date     yyyy-mm-dd, dd/mm/yyyy or dd.mm.yyyy between 1800 and 2199: the day is
         permuted within that 400-year cycle (146,097 = 189 * 773 days); where
         only mm/dd/yyyy or mm.dd.yyyy is a day, among the days past the 12th
email    letters and digits of the local part are permuted, the domain stays
=======  ==================================================================

Everything is a DataFrame expression. Each text stands alone, so nothing is
shuffled, and texts without a digit or @ are passed by. The key is hashed and
comes in by a one-row subquery, so neither it nor its hash is part of a plan's text.

Defined results: a null or empty text stays as it is; null ids and repeated rows
are treated like others; other columns stay, and ``pii`` gives way to the output;
an empty table stays empty. A value that fails its check stays as it is. Where
card spans overlap by chance (five groups of four digits, say), only the first
choice is taken; ``back`` can then choose otherwise.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_names

ROUNDS = 10
#: Java regular expressions of candidates, in order of precedence. A match must not touch further word characters.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
PHONE = r"\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
_N, _END = "[2-9][0-9]{2}", "(?![0-9A-Za-z]|[.-][0-9])"
NATIONAL = rf"(?<![0-9A-Za-z+.)-])(?:\({_N}\)[ ]?{_N}-[0-9]{{4}}|{_N}-{_N}-[0-9]{{4}}|{_N}[.]{_N}[.][0-9]{{4}}){_END}"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])"
#: A whole run of numbers, of any length, up to where another kind of value begins.
_NEXT = rf"[ -](?!{EMAIL}|{NATIONAL}|{IPV4}|{SSN}|{DATE})"
CARD = rf"(?<![A-Za-z0-9])(?=[0-9](?:(?:{_NEXT})?[0-9]){{12}}[0-9]*+(?![A-Za-z]))[0-9]++(?:{_NEXT}[0-9]++(?![A-Za-z]))*+"
CANDIDATE = "|".join((EMAIL, PHONE, NATIONAL, IPV4, SSN, DATE, CARD))
#: Days past the 12th in the months before each month of a common year.
_PAST = "array(0, 19, 35, 54, 72, 91, 109, 128, 147, 165, 184, 202)"
_LEAP = "filter(sequence(1800, 2199), y -> y % 4 = 0 and (y % 100 <> 0 or y % 400 = 0))"
_LETTERS, _DIGITS26 = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"


def _feistel(a: str, b: str, m: str, n: str, tweak: str, key: str, back: bool = False) -> str:
    """Struct (a, b) permuted in Z_m x Z_n: odd rounds shift a by a keyed hash of b, even ones b by one of a."""

    def value(of: str) -> str:
        return f"cast(conv(substr(sha2(concat_ws('|', {key}, {tweak}, r, {of}), 256), 1, 15), 16, 10) as bigint)"

    sign = "-" if back else "+"
    rounds = f"sequence({ROUNDS}, 1)" if back else f"sequence(1, {ROUNDS})"
    return (
        f"aggregate({rounds}, named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), (s, r) -> "
        f"if(r % 2 = 1, named_struct('a', pmod(s.a {sign} {value('s.b')} % {m}, {m}), 'b', s.b), named_struct('a', s.a, 'b', pmod(s.b {sign} {value('s.a')} % {n}, {n}))))"
    )


def _with(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def permute_digits(digits: str, tweak: str, key: str, back: bool = False) -> str:
    """SQL for a string of 1 to 18 digits permuted within its length."""
    u = f"cast(length({digits}) div 2 as int)"
    ten = "cast(rpad('1', 1 + {}, '0') as bigint)".format
    left, right = f"substr({digits}, 1, {u})", f"substr({digits}, 1 + {u})"
    run = _feistel(f"coalesce(try_cast({left} as bigint), 0)", right, ten(u), ten(f"length({digits}) - {u}"), f"concat({tweak}, length({digits}))", key, back)
    return _with("f", run, f"concat(if({u} = 0, '', lpad(cast(f.a as string), {u}, '0')), lpad(cast(f.b as string), cast(length({digits}) - {u} as int), '0'))")


def _permute_letters(letters: str, tweak: str, key: str, back: bool = False) -> str:
    """SQL for a string of 1 to 12 letters a-z permuted within its length."""
    u = f"cast(length({letters}) div 2 as int)"
    power = "cast(conv(rpad('1', 1 + {}, '0'), 26, 10) as bigint)".format
    number = lambda s: f"coalesce(cast(conv(translate({s}, '{_LETTERS}', '{_DIGITS26}'), 26, 10) as bigint), 0)"
    text = lambda n, size: f"translate(lpad(lower(conv({n}, 10, 26)), cast({size} as int), '0'), '{_DIGITS26}', '{_LETTERS}')"
    left, right = f"substr({letters}, 1, {u})", f"substr({letters}, 1 + {u})"
    run = _feistel(number(left), number(right), power(u), power(f"length({letters}) - {u}"), f"concat({tweak}, length({letters}))", key, back)
    return _with("f", run, f"concat(if({u} = 0, '', {text('f.a', u)}), {text('f.b', f'length({letters}) - {u}')})")


def _in_chunks(s: str, size: int, one: str) -> str:
    """``one`` (of piece p and index i) over pieces of ``size`` characters, concatenated."""
    return f"if(length({s}) = 0, '', array_join(transform(sequence(0, cast((length({s}) - 1) div {size} as int)), i -> {_with('p', f'substr({s}, cast(1 + i * {size} as int), {size})', one)}), ''))"


def _refill(m: str, digits: str, letters: str = "''") -> str:
    """``m`` with its digits and letters replaced, in order, by the given ones; case and the rest stay."""
    step = (
        f"if(c rlike '^[0-9]$', named_struct('o', concat(s.o, substr({digits}, s.d, 1)), 'd', s.d + 1, 'l', s.l), "
        f"if(length({letters}) > 0 and c rlike '^[A-Za-z]$', named_struct('o', concat(s.o, if(c rlike '[A-Z]', upper(substr({letters}, s.l, 1)), substr({letters}, s.l, 1))), 'd', s.d, 'l', s.l + 1), "
        "named_struct('o', concat(s.o, c), 'd', s.d, 'l', s.l)))"
    )
    return f"aggregate(split({m}, ''), named_struct('o', '', 'd', 1, 'l', 1), (s, c) -> {step}, s -> s.o)"


def _luhn_sum(digits: str) -> str:
    d = f"cast(substr({digits}, k, 1) as int)"
    return f"aggregate(sequence(1, length({digits})), 0, (s, k) -> s + if((length({digits}) - k) % 2 = 1, 2 * {d} - if({d} > 4, 9, 0), {d}))"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _card(m: str, key: str, back: bool) -> str:
    body = permute_digits("substr(d, 1, length(d) - 1)", "'card'", key, back)
    check = f"cast((10 - {_luhn_sum(chr(39) + chr(39)).replace(chr(39) * 2, 'concat(b, 0)')} % 10) % 10 as string)"
    return _with("d", _digits(m), _with("b", body, _refill(m, f"concat(b, {check})")))


def _cards(m: str, key: str, back: bool) -> str:
    """Array of (kind, value, piece): the card spans of a run of numbers and what lies between them."""
    valid = f"length(d) between 13 and 19 and d not rlike '^0+$' and {_luhn_sum('d')} % 10 = 0"
    usual = "x rlike '^([0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})[ -]?$'"
    span = f"named_struct('rank', if({usual}, 0, 1), 'at', i, 'less', -k)"
    tried = _with("x", "array_join(slice(g, i, k), '')", _with("d", _digits("x"), f"if({valid}, {span}, null)"))
    spans = f"array_sort(flatten(transform(sequence(1, size(g)), i -> filter(transform(sequence(1, least(19, size(g) - i + 1)), k -> {tried}), y -> y is not null))))"
    none = "cast(array() as array<struct<rank: int, at: int, less: int>>)"
    free = "not exists(s, z -> y.at < z.at - z.less and z.at < y.at - y.less)"
    chosen = f"array_sort(transform(aggregate({spans}, {none}, (s, y) -> if({free}, concat(s, array(y)), s)), y -> named_struct('at', y.at, 'k', -y.less)))"
    # Gaps lie before each card and behind the last one; a separator behind a card counts as a gap.
    last = "named_struct('at', size(g) + 1, 'k', 0)"
    end = "if(n = 0, 1, c[n - 1].at + c[n - 1].k)"
    gap = f"concat(if(n > 0 and {end} <= size(g), regexp_extract(g[{end} - 2], '[ -]$', 0), ''), array_join(slice(g, {end}, y.at - {end}), ''))"
    card = _with("p", "regexp_replace(array_join(slice(g, y.at, y.k), ''), '[ -]$', '')", f"named_struct('kind', 'card', 'value', {_card('p', key, back)}, 'piece', p)")
    piece = f"array(named_struct('kind', 'card', 'value', cast(null as string), 'piece', {gap}))"
    pieces = f"flatten(transform(concat(c, array({last})), (y, n) -> if(y.k = 0, {piece}, concat({piece}, array({card})))))"
    return _with("g", f"split({m}, '(?<=[ -])')", _with("c", chosen, pieces))


def _phone(m: str, key: str, back: bool) -> str:
    other = _with("n", f"concat(left(d, length(d) - 10), {permute_digits('right(d, 10)', chr(39) + 'phone' + chr(39), key, back)})", _refill(m, "n"))
    # Areas and exchanges from 200 on are those of valid numbers, which stay valid; the rest is permuted apart.
    area, rest = "cast(substr(t, 1, 3) as int)", "cast(substr(t, 4) as int)"
    kind = f"named_struct('a', if({area} < 200, 0, 200), 'm', if({area} < 200, 200, 800), 'b', if({area} < 200 or {rest} < 2000000, 0, 2000000), 'n', case when {area} < 200 then 10000000 when {rest} < 2000000 then 2000000 else 8000000 end)"
    run = _feistel(f"{area} - c.a", f"{rest} - c.b", "c.m", "c.n", "concat_ws('.', 'nanp', c.m, c.n)", key, back)
    new = "concat(left(d, length(d) - 10), lpad(cast(f.a + c.a as string), 3, '0'), lpad(cast(f.b + c.b as string), 7, '0'))"
    own = _with("t", "right(d, 10)", _with("c", kind, _with("f", run, _with("n", new, _refill(m, "n")))))
    return _with("d", _digits(m), f"if(length(d) = 10 or (length(d) = 11 and left(d, 1) = '1'), {own}, {other})")


def _ipv4(m: str, key: str, back: bool) -> str:
    o = lambda k: f"cast(o[{k}] as int)"
    run = _feistel(f"{o(0)} * 256 + {o(1)}", f"{o(2)} * 256 + {o(3)}", "65536", "65536", "'ipv4'", key, back)
    out = _with("f", run, "concat_ws('.', f.a div 256, f.a % 256, f.b div 256, f.b % 256)")
    return _with("o", f"split({m}, '[.]')", f"if(forall(o, x -> cast(x as int) <= 255 and (length(x) = 1 or x not like '0%')), {out}, null)")


def _ssn(m: str, key: str, back: bool) -> str:
    # 898 areas (001 to 899 without 666) and 99 * 9999 group and serial numbers: exactly the valid ones
    area = "cast(left(d, 3) as int) - if(left(d, 3) > '666', 2, 1)"
    rest = "(cast(substr(d, 4, 2) as int) - 1) * 9999 + cast(right(d, 4) as int) - 1"
    run = _feistel(area, rest, "898", "989901", "'ssn'", key, back)
    new = "concat(lpad(cast(f.a + if(f.a > 664, 2, 1) as string), 3, '0'), '-', lpad(cast(f.b div 9999 + 1 as string), 2, '0'), '-', lpad(cast(f.b % 9999 + 1 as string), 4, '0'))"
    return _with("d", _digits(m), f"if(d not rlike '^(000|666|9)' and substr(d, 4, 2) <> '00' and right(d, 4) <> '0000', {_with('f', run, new)}, null)")


def _date(m: str, key: str, back: bool) -> str:
    iso = f"if({m} like '____-__-__', {m}, concat_ws('-', substr({m}, 7, 4), substr({m}, 4, 2), substr({m}, 1, 2)))"
    day = _with("k", "datediff(v, date'1800-01-01')", f"if(k between 0 and 146096, {_feistel('k div 773', 'k % 773', '189', '773', chr(39) + 'date' + chr(39), key, back)}, null)")
    new = _with("f", day, "date_add(date'1800-01-01', cast(f.a * 773 + f.b as int))")
    text = f"if({m} like '____-__-__', date_format(n, 'yyyy-MM-dd'), date_format(n, if({m} like '__/__/____', 'dd/MM/yyyy', 'dd.MM.yyyy')))"
    other = f"if({m} like '____-__-__', null, {_month_first(m, key, back)})"
    return _with("v", f"try_cast({iso} as date)", f"if(v is null, {other}, {_with('n', new, text)})")


def _month_first(m: str, key: str, back: bool) -> str:
    """A day past the 12th with its month in front: 221 days times 400 years, and 29 February of 97 years by itself."""
    run = _feistel("year(v) - 1800", f"{_PAST}[month(v) - 1] + day(v) - 13", "400", "221", "'day'", key, back)
    month = f"size(filter({_PAST}, x -> x <= f.b))"
    common = _with("f", run, _with("w", month, f"make_date(cast(f.a + 1800 as int), w, cast(13 + f.b - {_PAST}[w - 1] as int))"))
    leap = _with("f", _feistel(f"array_position({_LEAP}, year(v)) - 1", "0", "97", "1", "'leap'", key, back), f"make_date({_LEAP}[cast(f.a as int)], 2, 29)")
    text = f"date_format(n, if({m} like '__/__/____', 'MM/dd/yyyy', 'MM.dd.yyyy'))"
    new = _with("n", f"if(date_format(v, 'MMdd') = '0229', {leap}, {common})", text)
    value = f"try_cast(concat_ws('-', substr({m}, 7, 4), substr({m}, 1, 2), substr({m}, 4, 2)) as date)"
    return _with("v", value, f"if(v is null or year(v) not between 1800 and 2199, null, {new})")


def _email(m: str, key: str, back: bool) -> str:
    digits = _in_chunks("d", 18, permute_digits("p", "concat('email', i)", key, back))
    letters = _in_chunks("t", 12, _permute_letters("p", "concat('email', i)", key, back))
    local = f"substring_index({m}, '@', 1)"
    body = _with("w", digits, _with("x", letters, f"concat({_refill(local, 'w', 'x')}, substr({m}, 1 + length({local})))"))
    return _with("d", _digits(local), _with("t", f"regexp_replace(lower({local}), '[^a-z]', '')", f"if(length(d) + length(t) > 0, {body}, null)"))


def _pseudonym(m: str, key: str, back: bool) -> str:
    """Array of (kind, value, piece), the pieces of the match: value is null where a piece isn't valid."""
    kinds = (("email", "like '%@%'", _email), ("phone", r"rlike '^([+(]|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$)'", _phone), ("ipv4", r"rlike '^[0-9]{1,3}([.][0-9]{1,3}){3}$'", _ipv4), ("ssn", "rlike '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'", _ssn), ("date", "rlike '^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})$'", _date))
    cases = " ".join(f"when {m} {test} then array(named_struct('kind', '{kind}', 'value', {make(m, key, back)}, 'piece', {m}))" for kind, test, make in kinds)
    return f"case {cases} else {_cards(m, key, back)} end"


def pseudonymise(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """``docs`` with values in ``text`` replaced and ``pii``, the kind and pseudonym of each in order.

    ``back`` turns pseudonyms into the values they stand for.
    """
    pattern = F.lit(CANDIDATE)
    text: Column = F.col("text").cast("string")
    worth = text.rlike("[0-9@]") & text.rlike(CANDIDATE)
    found = F.when(worth, F.regexp_extract_all(text, pattern, F.lit(0)))
    rest = F.when(worth, F.split(text, CANDIDATE, -1))
    docs = docs.drop("pii")
    names = free_names(docs, "pii_found", "pii_rest", "pii_key", "pii_new")
    f, r, k, n = names
    hashed = docs.sparkSession.createDataFrame([(hash_key(key),)], "key string")
    rows = docs.withColumns({f: found, r: rest, k: hashed.scalar()})
    rows = rows.withColumn(n, F.expr(f"transform({f}, m -> {_pseudonym('m', k, back)})"))
    glued = F.expr(f"array_join(zip_with({r}, transform({n}, v -> array_join(transform(v, p -> coalesce(p.value, p.piece)), '')), (r, v) -> concat(r, coalesce(v, ''))), '')")
    rows = rows.withColumn("text", F.when(F.col(f).isNull(), F.col("text")).otherwise(glued))
    kinds = f"transform(filter(flatten({n}), v -> v.value is not null), v -> named_struct('kind', v.kind, 'value', v.value))"
    rows = rows.withColumn("pii", F.coalesce(F.expr(kinds), F.expr("cast(array() as array<struct<kind: string, value: string>>)")))
    return rows.drop(*names)


def hash_key(key: str) -> str:
    return hashlib.sha256(f"vestigo feistel {key}".encode()).hexdigest()
