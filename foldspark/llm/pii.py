"""Personal numbers, dates and addresses replaced by format-preserving pseudonyms.

Each value found is validated first (check digits, ranges, calendar), then
permuted by a keyed Feistel network within its own format: a card number stays
a card number of its length with a right check digit, a date a date of its
century in the same notation. Equal values get equal pseudonyms in every
document, different values of one format different ones, and nothing is stored.

| kind | form | what is permuted |
|---|---|---|
| e-mail address | name@host | letters and digits of the name, each within its class |
| IBAN | country, 2 check digits, 11 to 30 letters and digits | letters and digits within their class; check digits renewed |
| card number | 13 to 19 digits, blanks or hyphens between | all but the first digit; check digit renewed |
| social security number | ddd-dd-dddd | area, group and serial within their valid ranges |
| telephone number | +country and 7 to 14 digits, or 10 digits in the groups of North America | digits behind the country code; valid North American area and exchange codes stay valid |
| IPv4 address | four numbers up to 255 | all 32 bits |
| date | yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, dd/mm/yyyy, else mm/dd/yyyy; years 1000 to 9999 | the day within its century; a date that only reads as mm/dd among such dates |

All of it is SQL functions: a text is split at the matches of one pattern, each
match is mapped, and the parts are joined again. Texts without a match are not
touched.

Defined cases: a null text stays null; an empty text stays empty; a match that
fails its validation stays as it is; repeated rows are rows like any other; an empty table
gives no rows; other columns are kept, but a column named ``n_pii`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6

_EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}"
_IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_DATE = r"(?:[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}|[1-9][0-9]{3}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[1-9][0-9]{3}|[0-9]{2}/[0-9]{2}/[1-9][0-9]{3})"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
_PHONE = r"\+1[ .-]?\(?[2-9][0-9]{2}\)?[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}|\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}|\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
_IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
_CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
#: One match at a time, in the order of the alternatives; numbers must not continue on either side.
_NUMBER_END = r"(?![0-9]|[.,-][0-9])"
PATTERN = (
    rf"(?<![A-Za-z0-9._%+-]){_EMAIL}(?![A-Za-z0-9])"
    rf"|(?<![A-Za-z0-9]){_IBAN}"
    rf"|(?<![A-Za-z0-9+]|[0-9][.,/-])(?:{_DATE}|{_SSN}|{_IP}|{_CARD}){_NUMBER_END}(?![A-Za-z]|/[0-9])"
    rf"|(?<![A-Za-z0-9]|[0-9][.,/-])(?:{_PHONE}){_NUMBER_END}(?![A-Za-z])"
)


def _hash(key: str, kind: str, round_: int, half: Column) -> Column:
    """52 bits that depend on the key, the kind, the round and a half of the value."""
    text = F.concat(F.lit(f"{key}|{kind}|{round_}|"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def _bind(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


#: Steps of a walk; each leaves the set with a probability below 0.65, so all fail once in 10^37 values.
WALK = 200


def _walk(value: Column, step, inside) -> Column:
    """``step`` repeated until ``inside`` holds again (cycle walking): a permutation of a set becomes one of its part."""
    return F.aggregate(F.sequence(F.lit(2), F.lit(WALK)), step(value), lambda x, _: F.when(inside(x), x).otherwise(step(x)))


def _feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """Struct (l, r): the permuted halves of a number, left in [0, a), right in [0, b)."""

    def round_(n: int, pair: Column) -> Column:
        if n == ROUNDS:
            return pair
        if n % 2:
            changed = F.struct(pair["l"].alias("l"), F.pmod(pair["r"] + _hash(key, kind, n, pair["l"]), b).cast("long").alias("r"))
        else:
            changed = F.struct(F.pmod(pair["l"] + _hash(key, kind, n, pair["r"]), a).cast("long").alias("l"), pair["r"].alias("r"))
        return _bind(changed, lambda p: round_(n + 1, p))

    return _bind(F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), lambda p: round_(0, p))


def _permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """A string of up to 36 digits permuted among those of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    left = F.coalesce(F.substr(digits, F.lit(1), half).try_cast("long"), F.lit(0).cast("long"))
    right = F.coalesce(F.substr(digits, half + 1, n - half).try_cast("long"), F.lit(0).cast("long"))
    ten = lambda k: F.pow(F.lit(10.0), k).cast("long")

    def shown(p: Column) -> Column:
        return F.concat(
            F.when(half > 0, F.lpad(p["l"].cast("string"), half, "0")).otherwise(""), F.lpad(p["r"].cast("string"), n - half, "0")
        )

    return _bind(_feistel(key, kind, left, right, ten(half), ten(n - half)), shown)


def _with_format(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits`` from left to right."""
    places = F.split(shape, "")
    state = F.aggregate(
        places,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.rlike("^[0-9]$"),
            F.struct(F.concat(s["out"], F.substr(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
    )
    return state["out"]


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits; the last digit has weight 1."""
    places = F.split(F.reverse(digits), "")
    doubled = F.transform(
        places,
        lambda c, i: F.when(
            F.pmod(i, F.lit(2)) == 1, F.pmod(c.try_cast("int") * 2, F.lit(10)) + F.when(c.try_cast("int") > 4, 1).otherwise(0)
        ).otherwise(c.try_cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _card(key: str, match: Column) -> Column:
    digits = _only_digits(match)

    def new(d: Column) -> Column:
        n = F.length(d)
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), _permuted_digits(key, "card", F.substr(d, F.lit(2), n - 2)))
        return _bind(
            body,
            lambda x: _with_format(
                match, F.concat(x, F.pmod(F.lit(10) - F.pmod(_luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string"))
            ),
        )

    same = F.length(F.regexp_replace(digits, F.concat(F.lit("^"), F.substr(digits, F.lit(1), F.lit(1)), F.lit("+")), F.lit(""))) == 0
    return F.when((F.pmod(_luhn_sum(digits), F.lit(10)) == 0) & ~same, _bind(digits, new)).otherwise(match)


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _shifted(text: Column, stream: Column) -> Column:
    """Letters and digits moved within their class by a stream of hex pairs."""

    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substr(stream, F.pmod(i * 4, F.lit(60)).cast("int") + 1, F.lit(4)), 16, 10).cast("int") + i

        def within(alphabet: str) -> Column:
            place = F.instr(F.lit(alphabet), c) - 1
            return F.substr(F.lit(alphabet), F.pmod(place + by, F.lit(len(alphabet))).cast("int") + 1, F.lit(1))

        return (
            F.when(c.rlike("^[a-z]$"), within(_LETTERS))
            .when(c.rlike("^[A-Z]$"), within(_LETTERS.upper()))
            .when(c.rlike("^[0-9]$"), within("0123456789"))
            .otherwise(c)
        )

    return F.when(F.length(text) > 0, F.array_join(F.transform(F.split(text, ""), move), "")).otherwise(text)


def _permuted_text(key: str, kind: str, text: Column) -> Column:
    """Letters and digits of a text permuted within their classes, half by half."""
    half = F.floor(F.length(text) / 2).cast("int")

    def round_(n: int, pair: Column) -> Column:
        if n == ROUNDS:
            return F.concat(pair["l"], pair["r"])
        stream = lambda other: F.sha2(F.concat(F.lit(f"{key}|{kind}|{n}|"), other), 256)
        if n % 2:
            changed = F.struct(pair["l"].alias("l"), _shifted(pair["r"], stream(pair["l"])).alias("r"))
        else:
            changed = F.struct(_shifted(pair["l"], stream(pair["r"])).alias("l"), pair["r"].alias("r"))
        return _bind(changed, lambda p: round_(n + 1, p))

    parts = F.struct(
        F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text) - half).alias("r")
    )
    return _bind(parts, lambda p: round_(0, p))


def _email(key: str, match: Column) -> Column:
    name = F.substring_index(match, "@", 1)
    return F.concat(_permuted_text(key, "email", name), F.substr(match, F.length(name) + 1, F.length(match)))


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a text of digits and capital letters (A is 10, Z is 35)."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda s, c: F.when(c.rlike("^[0-9]$"), F.pmod(s * 10 + F.coalesce(c.try_cast("int"), F.lit(0)), F.lit(97))).otherwise(
            F.pmod(s * 100 + F.ascii(c) - 55, F.lit(97))
        ),
    )


def _iban(key: str, match: Column) -> Column:
    plain = F.regexp_replace(match, " ", "")
    country, rest = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
    right = _mod97(F.concat(rest, F.substr(plain, F.lit(1), F.lit(4)))) == 1

    def new(body: Column) -> Column:
        check = F.lpad((F.lit(98) - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
        whole = F.concat(country, check, body)
        # blanks of the match at their places
        return F.aggregate(
            F.split(match, ""),
            F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
            lambda s, c: F.when(c == " ", F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))).otherwise(
                F.struct(F.concat(s["out"], F.substr(whole, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))
            ),
        )["out"]

    return F.when(right, _bind(_permuted_text(key, "iban", rest), new)).otherwise(match)


def _int(text: Column, at: int, n: int) -> Column:
    return F.coalesce(F.substring(text, at, n).try_cast("long"), F.lit(0).cast("long"))


def _ssn(key: str, match: Column) -> Column:
    area, group, serial = _int(match, 1, 3), _int(match, 5, 2), _int(match, 8, 4)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    left = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1  # 898 areas x 99 groups

    def shown(p: Column) -> Column:
        place = F.floor(p["l"] / 99) + 1
        return F.concat_ws(
            "-",
            F.lpad((place + F.when(place >= 666, 1).otherwise(0)).cast("string"), 3, "0"),
            F.lpad((F.pmod(p["l"], F.lit(99)) + 1).cast("string"), 2, "0"),
            F.lpad((p["r"] + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, _bind(_feistel(key, "ssn", left, serial - 1, F.lit(898 * 99), F.lit(9999)), shown)).otherwise(match)


def _north_american(key: str, digits: Column) -> Column:
    """Ten digits, area and exchange from 200 up, permuted among such numbers."""
    left = (_int(digits, 1, 3) - 200) * 800 + _int(digits, 4, 3) - 200

    def shown(p: Column) -> Column:
        return F.concat(
            (F.floor(p["l"] / 800) + 200).cast("string"),
            (F.pmod(p["l"], F.lit(800)) + 200).cast("string"),
            F.lpad(p["r"].cast("string"), 4, "0"),
        )

    return _bind(_feistel(key, "phone", left, _int(digits, 7, 4), F.lit(640_000), F.lit(10_000)), shown)


def _phone(key: str, match: Column) -> Column:
    digits = _only_digits(match)
    foreign = match.startswith("+")
    code = F.when(foreign, F.length(F.regexp_extract(match, r"^\+([0-9]{1,3})", 1))).otherwise(0)
    # without a separator behind it, the country code is taken as one digit for 1 and 7, else two
    glued = match.rlike(r"^\+[0-9]{4}")
    code = F.when(foreign & glued, F.when(match.rlike(r"^\+[17]"), 1).otherwise(2)).otherwise(code)
    n = F.length(digits)

    def new(rest: Column) -> Column:
        national = (F.length(rest) == 10) & ((code == 0) | ((code == 1) & match.startswith("+1")))
        valid = lambda d: d.rlike("^[2-9][0-9]{2}[2-9]")
        free = lambda d: _permuted_digits(key, "phone", d)
        # other numbers of ten digits stay outside the valid ones
        changed = (
            F.when(national & valid(rest), _north_american(key, rest))
            .when(national, _walk(rest, free, lambda d: ~valid(d)))
            .otherwise(free(rest))
        )
        return _with_format(match, F.concat(F.substr(digits, F.lit(1), code), changed))

    valid = F.when(foreign, (n >= 8) & (n <= 15)).otherwise(n == 10)
    return F.when(valid, _bind(F.substr(digits, code + 1, n - code), new)).otherwise(match)


def _ip(key: str, match: Column) -> Column:
    part = F.split(match, r"\.")
    value = [F.coalesce(F.get(part, F.lit(i)).try_cast("long"), F.lit(999).cast("long")) for i in range(4)]
    valid = (value[0] <= 255) & (value[1] <= 255) & (value[2] <= 255) & (value[3] <= 255) & ~match.rlike(r"(?:^|\.)0[0-9]")

    def shown(p: Column) -> Column:
        return F.concat_ws(
            ".", F.floor(p["l"] / 256).cast("string"), F.pmod(p["l"], F.lit(256)).cast("string"),
            F.floor(p["r"] / 256).cast("string"), F.pmod(p["r"], F.lit(256)).cast("string"),
        )

    pair = _feistel(key, "ip", value[0] * 256 + value[1], value[2] * 256 + value[3], F.lit(65_536), F.lit(65_536))
    return F.when(valid, _bind(pair, shown)).otherwise(match)


def _date(key: str, match: Column) -> Column:
    first = match.rlike("^[0-9]{4}")
    year = F.when(first, F.substring(match, 1, 4)).otherwise(F.substring(match, 7, 4))
    one = F.when(first, F.substring(match, 6, 2)).otherwise(F.substring(match, 4, 2))  # month
    two = F.when(first, F.substring(match, 9, 2)).otherwise(F.substring(match, 1, 2))  # day
    day = F.concat_ws("-", year, one, two).try_cast("date")
    other = F.concat_ws("-", year, two, one).try_cast("date")  # mm/dd/yyyy
    swapped = day.isNull() & match.rlike("^[0-9]{2}/")

    def new(d: Column) -> Column:
        begin = F.make_date((F.floor(F.year(d) / 100) * 100).cast("int"), F.lit(1), F.lit(1))
        leap = F.pmod(F.floor(F.year(d) / 100), F.lit(4)) == 0  # 36,525 days instead of 36,524
        b = F.when(leap, 487).otherwise(397).cast("long")
        a = F.when(leap, 75).otherwise(92).cast("long")

        def moved(x: Column) -> Column:
            days = F.datediff(x, begin).cast("long")
            pair = _feistel(key, "date", F.floor(days / b), F.pmod(days, b), a, b)
            return _bind(pair, lambda p: F.date_add(begin, (p["l"] * b + p["r"]).cast("int")))

        def shown(x: Column) -> Column:
            return (
                F.when(match.contains("-"), F.date_format(x, "yyyy-MM-dd"))
                .when(match.contains("."), F.date_format(x, "dd.MM.yyyy"))
                .when(first, F.date_format(x, "yyyy/MM/dd"))
                .when(swapped, F.date_format(x, "MM/dd/yyyy"))
                .otherwise(F.date_format(x, "dd/MM/yyyy"))
            )

        # a date that only reads as mm/dd stays one, so that it never meets the image of a dd/mm date
        return _bind(F.when(swapped, _walk(d, moved, lambda x: F.dayofmonth(x) > 12)).otherwise(moved(d)), shown)

    value = F.when(swapped, other).otherwise(day)
    return F.when(value.isNotNull(), _bind(value, new)).otherwise(match)


def pseudonym(key: str, match: Column) -> Column:
    """The pseudonym of one match of ``PATTERN``; the match itself if it isn't valid."""
    return (
        F.when(match.contains("@"), _email(key, match))
        .when(match.rlike("^[A-Z]{2}"), _iban(key, match))
        .when(match.rlike(f"^{_DATE}$"), _date(key, match))
        .when(match.rlike(f"^{_SSN}$"), _ssn(key, match))
        .when(match.rlike(f"^{_IP}$"), _ip(key, match))
        .when(match.rlike(rf"^\+|^\(|^[0-9]{{3}}\)?[ .-][0-9]{{3}}[ .-][0-9]{{4}}$"), _phone(key, match))
        .otherwise(_card(key, match))
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal values of the text replaced, and ``n_pii``, how many were."""
    text = F.col(text_col).cast("string")
    matches = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    # most texts have neither a digit nor an at sign, which is far quicker to see
    found, new = "_found", "_new"
    while {found, new} & {c.lower() for c in docs.columns}:
        found, new = f"_{found}", f"_{new}"
    rows = docs.drop("n_pii").withColumn(found, F.when(text.rlike("[0-9@]") & text.rlike(PATTERN), matches))
    rows = rows.withColumn(new, F.transform(found, lambda m: pseudonym(key, m)))
    joined = F.array_join(F.zip_with(F.split(text, PATTERN, -1), F.col(new), lambda gap, m: F.concat(gap, F.coalesce(m, F.lit("")))), "")
    n = F.aggregate(F.zip_with(found, new, lambda a, b: (a != b).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    own = [F.when(F.col(found).isNull(), F.col(c)).otherwise(joined).alias(c) if c == text_col else F.col(c) for c in docs.columns if c != "n_pii"]
    return rows.select(*own, F.coalesce(n, F.lit(0).cast("long")).alias("n_pii"))
