"""Personal data replaced by format-preserving pseudonyms, in DataFrame functions only.

Found numbers, dates and addresses are checked (check digits, ranges, calendar) and then permuted
within their own format by a keyed Feistel network: a telephone number becomes another telephone
number, a card number another one whose check digit fits.  The permutation hangs on the key and
the kind alone, so equal values get equal pseudonyms in every document, different values different
ones, and whoever has the key can undo it.  What looks like personal data but fails its check stays.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.syncmers import let

ROUNDS = 10
# Steps of a walk through a larger domain; a longer walk has a chance below 1e-20.
WALK_STEPS = 200

# Steps of a walk through dates or telephone numbers of which well over half qualify.
SHORT_WALK = 100

# Dates are permuted within these days, both included.
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
_DAYS = (date.fromisoformat(LAST_DAY) - date.fromisoformat(FIRST_DAY)).days + 1

KINDS: dict[str, str] = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}"
             r"@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){1,8}",
    "ip": r"(?<![\p{L}\p{N}.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\p{L}\p{N}]|\.\d)",
    "date": r"(?<![\p{L}\p{N}./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})"
            r"(?![\p{L}\p{N}]|[-/]\d)",
    "card": r"(?<![\p{L}\p{N}.-])(?:\d{4}([ -])\d{4}\g\d{4}\g\d{4}|\d{4}([ -])\d{6}\g\d{5}|\d{13,19})"
            r"(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?\d{3}[ .-]\d{4}"
             r"|\d{3}([ .-])\d{3}\g\d{4})(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\p{L}\p{N}])",
}


def _numbered_groups(kinds: dict[str, str]) -> str:
    """One pattern for all kinds; a ``\\g`` refers to the group opened last before it."""
    out, group = [], 0
    for pattern in kinds.values():
        text, i = "", 0
        while i < len(pattern):
            if pattern.startswith(r"\g", i):
                text += f"\\{group}"
                i += 2
                continue
            if pattern[i] == "\\":
                text += pattern[i:i + 2]
                i += 2
                continue
            if pattern[i] == "(" and pattern[i + 1] != "?":
                group += 1
            text += pattern[i]
            i += 1
        out.append(text)
    return "|".join(out)


PATTERN = _numbered_groups(KINDS)


def _kind_pattern(kind: str) -> str:
    return "^(?:" + _numbered_groups({kind: KINDS[kind]}) + ")$"


def _stream(key: str, tweak: str, round_no: Column, source: Column) -> Column:
    """64 pseudo-random hex digits from the key, the kind, the round and one half."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), round_no.cast("string"), source), 256)


# Runs of code points that are all letters of one script and one case.
LETTERS: tuple[tuple[int, int], ...] = (
    (0x00C0, 0x00D6), (0x00D8, 0x00DE), (0x00DF, 0x00F6), (0x00F8, 0x00FF),   # Latin-1
    (0x0391, 0x03A1), (0x03A3, 0x03A9), (0x03B1, 0x03C9),                     # Greek
    (0x0400, 0x042F), (0x0430, 0x045F),                                       # Cyrillic
    (0x0531, 0x0556), (0x0561, 0x0586), (0x05D0, 0x05EA),                     # Armenian, Hebrew
    (0x0621, 0x063A), (0x0641, 0x064A), (0x0905, 0x0939), (0x0E01, 0x0E30),   # Arabic, Devanagari, Thai
    (0x10D0, 0x10FA), (0x3041, 0x3096), (0x30A1, 0x30FA),                     # Georgian, Kana
    (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),                                       # Han, Hangul
)


def _shifted(char: Column, by: Column, any_script: bool) -> Column:
    """A character moved on within its class: digits, small or capital letters and, in any script,
    one of the runs of ``LETTERS``; others stay."""
    code = F.ascii(char)

    def within(first: str, size: int) -> Column:
        return F.char(F.lit(ord(first)) + F.pmod(code - ord(first) + by, F.lit(size)))

    def elsewhere(run: Column) -> Column:
        point = run["first"] + F.pmod(code - run["first"] + by, run["last"] - run["first"] + 1)
        return F.when(run.isNull(), char).otherwise(
            F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))

    other = char
    if any_script:
        runs = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("last")) for a, b in LETTERS])
        here = F.get(F.filter(runs, lambda r: code.between(r["first"], r["last"])), 0)
        other = F.when(code < LETTERS[0][0], char).otherwise(let(here, elsewhere))
    return (F.when(char.between("0", "9"), within("0", 10))
            .when(char.between("a", "z"), within("a", 26))
            .when(char.between("A", "Z"), within("A", 26)).otherwise(other))


def permute_text(value: Column, key: str, tweak: str, any_script: bool = False) -> Column:
    """Feistel network over characters: in turn each half is moved on by a stream made from the
    other.  Length and the class of every character stay; ``any_script`` moves letters beyond
    ASCII too."""
    def moved(target: Column, source: Column, round_no: Column) -> Column:
        def of(stream: Column) -> Column:
            def one(i: Column) -> Column:
                pair = F.substring(stream, F.pmod(i - 1, F.lit(31)) * 2 + 1, F.lit(4))
                return _shifted(F.substring(target, i, F.lit(1)),
                                F.conv(pair, 16, 10).cast("int"), any_script)
            return F.array_join(F.transform(
                F.sequence(F.lit(1), F.length(target)), one), "")
        made = let(_stream(key, tweak, round_no, source), of)
        return F.when(F.length(target) == 0, target).otherwise(made)

    def halves(v: Column) -> Column:
        cut = F.floor(F.length(v) / 2).cast("int")
        start = F.struct(F.substring(v, F.lit(1), cut).alias("a"),
                         F.substring(v, cut + 1, F.length(v)).alias("b"))

        def step(acc: Column, i: Column) -> Column:
            even = i % 2 == 0
            return F.struct(
                F.when(even, moved(acc["a"], acc["b"], i)).otherwise(acc["a"]).alias("a"),
                F.when(even, acc["b"]).otherwise(moved(acc["b"], acc["a"], i)).alias("b"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step,
                           lambda acc: F.concat(acc["a"], acc["b"]))

    return let(value, halves)


def permute_number(value: Column, size: int, key: str, tweak: str) -> Column:
    """Feistel network over the numbers 0 to ``size`` - 1, walking on while outside of them."""
    half = max(1, -(-(size - 1).bit_length() // 2))
    mask = F.lit((1 << half) - 1)

    def once(v: Column) -> Column:
        start = F.struct(F.shiftright(v, half).alias("a"), v.bitwiseAND(mask).alias("b"))

        def step(acc: Column, i: Column) -> Column:
            made = F.conv(F.substring(_stream(key, tweak, i, acc["b"].cast("string")), 1, 8), 16, 10)
            return F.struct(acc["b"].alias("a"), acc["a"].bitwiseXOR(
                made.cast("long").bitwiseAND(mask)).alias("b"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step,
                           lambda acc: F.shiftleft(acc["a"], half).bitwiseOR(acc["b"]))

    first = once(value.cast("long"))
    if size == 1 << (2 * half):
        return first
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK_STEPS)), first,
                       lambda v, _: F.when(v < size, v).otherwise(once(v)))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def refilled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced in order by ``digits``."""
    def one(i: Column) -> Column:
        place = F.length(digits_of(F.substring(form, F.lit(1), i)))
        here = F.substring(form, i, F.lit(1))
        return F.when(here.between("0", "9"), F.substring(digits, place, F.lit(1))).otherwise(here)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), one), "")


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(permute_text(local, key, "email", any_script=True), F.lit("@"), F.substring_index(m, "@", -1))


def _ip(m: Column, key: str) -> Column:
    def of(parts: Column) -> Column:
        octets = [F.get(parts, i).cast("long") for i in range(4)]
        number = octets[0] * (1 << 24) + octets[1] * (1 << 16) + octets[2] * (1 << 8) + octets[3]
        valid = F.greatest(*octets) <= 255

        def form(n: Column) -> Column:
            return F.concat_ws(".", *[F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string")
                                      for s in (24, 16, 8, 0)])
        return F.when(valid, let(permute_number(number, 1 << 32, key, "ip"), form)).otherwise(m)

    return let(F.split(m, r"\."), of)


def _date(m: Column, key: str) -> Column:
    """With slashes the month comes first, unless the first number is above 12: then the day does,
    and the pseudonym is such a date too, so that no two dates become one."""
    first = F.lit(FIRST_DAY).cast("date")

    def moved(day: Column) -> Column:
        number = permute_number(F.datediff(day, first), _DAYS, key, "date")
        return F.date_add(first, number.cast("int"))

    def walked(day: Column) -> Column:
        """One step, and where the day comes first as many as it takes to pass the twelfth."""
        return F.aggregate(
            F.when(day_first, F.sequence(F.lit(1), F.lit(SHORT_WALK))).otherwise(F.array(F.lit(1))),
            F.struct(day.alias("d"), F.lit(False).alias("done")), step, lambda acc: acc["d"])

    def step(acc: Column, _: Column) -> Column:
        def of(d: Column) -> Column:
            return F.struct(d.alias("d"), (~day_first | (F.dayofmonth(d) > 12)).alias("done"))
        return F.when(acc["done"], acc).otherwise(let(moved(acc["d"]), of))

    day_first = m.contains("/") & (F.substring(m, 1, 2) > "12")
    form = (F.when(m.contains("-"), "yyyy-MM-dd").when(m.contains("."), "dd.MM.yyyy")
            .when(day_first, "dd/MM/yyyy").otherwise("MM/dd/yyyy"))

    def of_day(day: Column) -> Column:
        inside = day.between(first, F.lit(LAST_DAY).cast("date"))
        return F.when(inside, F.call_function("date_format", walked(day).cast("timestamp"), form)).otherwise(m)

    return let(F.try_to_timestamp(m, form).cast("date"), of_day)


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _card(m: Column, key: str) -> Column:
    def of(d: Column) -> Column:
        n = F.length(d)
        body = F.concat(F.substring(d, 1, 1), permute_text(
            F.substring(d, F.lit(2), n - 2), key, "card"))

        def checked(b: Column) -> Column:
            fits = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.concat(
                b, c.cast("string"))), _luhn)
            return refilled(m, F.get(fits, 0))
        return F.when(_luhn(d) & (F.regexp_replace(d, "0", "") != ""),
                      let(body, checked)).otherwise(m)

    return let(digits_of(m), of)


def _ssn(m: Column, key: str) -> Column:
    valid = r"^(?!000|666|9)\d{3}(?!00)\d{2}(?!0000)\d{4}$"

    def of(d: Column) -> Column:
        walked = F.aggregate(
            F.sequence(F.lit(1), F.lit(WALK_STEPS)), permute_text(d, key, "ssn"),
            lambda v, _: F.when(v.rlike(valid), v).otherwise(permute_text(v, key, "ssn")))
        return F.when(d.rlike(valid), refilled(m, walked)).otherwise(m)

    return let(digits_of(m), of)


def _mod97(text: Column) -> Column:
    """Remainder by 97 of an account number: letters count as 10 to 35."""
    def step(acc: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (acc * 10 + c.cast("int")) % 97).otherwise(
            (acc * 100 + F.ascii(c) - 55) % 97)

    chars = F.split(text, "")
    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), step)


def _iban(m: Column, key: str) -> Column:
    def of(plain: Column) -> Column:
        country = F.substring(plain, 1, 2)
        body = F.substring(plain, F.lit(5), F.length(plain))
        valid = _mod97(F.concat(body, F.substring(plain, 1, 4))) == 1

        def made(b: Column) -> Column:
            check = F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
            return F.concat(country, check, b)

        def spaced(new: Column) -> Column:
            def one(i: Column) -> Column:
                place = F.length(F.replace(F.substring(m, F.lit(1), i), F.lit(" ")))
                here = F.substring(m, i, F.lit(1))
                return F.when(here == " ", here).otherwise(F.substring(new, place, F.lit(1)))
            return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), one), "")

        return F.when(valid, let(let(permute_text(body, key, "iban"), made), spaced)).otherwise(m)

    return let(F.replace(m, F.lit(" ")), of)


def _phone(m: Column, key: str) -> Column:
    """A country code stays.  Numbers with one must be of 7 to 15 digits.  A number with neither
    country code nor brackets must be a North American one, whose area and exchange codes begin
    with 2 to 9; its pseudonym is one too."""
    def of(prefix: Column) -> Column:
        rest = F.substring(m, F.length(prefix) + 1, F.length(m))
        return F.concat(prefix, let(rest, lambda r: refilled(r, permute_text(
            digits_of(r), key, "phone"))))

    def bare(d: Column) -> Column:
        walked = F.aggregate(
            F.sequence(F.lit(1), F.lit(SHORT_WALK)), permute_text(d, key, "bare phone"),
            lambda v, _: F.when(v.rlike(american), v).otherwise(permute_text(v, key, "bare phone")))
        return F.when(d.rlike(american), refilled(m, walked)).otherwise(m)

    american = r"^[2-9]\d{2}[2-9]\d{6}$"
    marked = let(F.regexp_extract(m, r"^\+\d{1,3}(?=[ .(-])", 0), of)
    length = F.length(digits_of(m))
    plus = m.startswith("+")
    return (F.when(plus & ~length.between(7, 15), m).when(plus | m.contains("("), marked)
            .otherwise(let(digits_of(m), bare)))


_MAKERS: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "ip": _ip, "date": _date, "card": _card, "ssn": _ssn, "iban": _iban,
    "phone": _phone,
}


def pseudonym(match: Column, key: str) -> Column:
    """``struct<kind, value>`` of one found string; kind is null where its check fails."""
    kind, value = F.lit(None).cast("string"), match
    for name in reversed(KINDS):
        is_kind = match.rlike(_kind_pattern(name))
        kind = F.when(is_kind, F.lit(name)).otherwise(kind)
        value = F.when(is_kind, _MAKERS[name](match, key)).otherwise(value)
    return F.struct(kind.alias("kind"), value.alias("value"))


def pseudonymise(docs: DataFrame, key: str, counts: bool = False) -> DataFrame:
    """``docs`` with every valid personal value in ``text`` replaced; other columns stay.

    With ``counts``, a column ``pii_counts`` (kind to number of values replaced) is added.  Null
    texts stay null, empty and clean ones stay as they are, rows are kept one by one, repeated ones
    and null ids too, and no other column is touched, but for one that is called ``pii_counts``
    where that is asked for.  A date, number or address that its check rejects is left in place;
    secrets that are no one's number (tokens, digests) are too, and so are the domains of mail
    addresses, which name a provider.
    """
    text = docs["text"].cast("string")

    def found() -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)),
                           lambda m: F.struct(m.alias("was"), pseudonym(m, key).alias("new")))

    def joined(matches: Column) -> Column:
        # The gaps between the pattern's matches and the matches take turns, from gap to gap.
        return F.array_join(F.zip_with(
            F.split(text, PATTERN, -1), matches,
            lambda gap, m: F.concat(gap, F.coalesce(m["new"]["value"], F.lit("")))), "")

    def tally(matches: Column) -> Column:
        kinds = F.transform(F.filter(matches, lambda m: m["was"] != m["new"]["value"]),
                            lambda m: m["new"]["kind"])

        def of(replaced: Column) -> Column:
            entries = [F.struct(F.lit(k).alias("key"), F.size(F.filter(replaced, _equals(k)))
                                .alias("value")) for k in KINDS]
            return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"] > 0))

        return let(kinds, of)

    has_any = F.coalesce(text.rlike(PATTERN), F.lit(False))
    if not counts:
        return docs.withColumn("text", F.when(has_any, let(found(), joined)).otherwise(text))
    none = F.create_map().cast("map<string,int>")
    # Both columns come from one array of matches, so that each is permuted once.
    both = F.when(has_any, let(found(), lambda m: F.struct(
        joined(m).alias("text"), tally(m).alias("counts")))).otherwise(
        F.struct(text.alias("text"), none.alias("counts")))
    made = "_made"
    while made in docs.columns:
        made += "_"
    return docs.withColumn(made, both).withColumns({
        "text": F.col(made)["text"], "pii_counts": F.col(made)["counts"]}).drop(made)


def _equals(kind: str) -> Callable[[Column], Column]:
    return lambda x: x == kind
