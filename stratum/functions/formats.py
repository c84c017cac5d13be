"""Tokens that look like what they stand for: digits become digits, letters letters, all else stays.

The digits of a value, as one number, are permuted by a keyed Feistel network, and so are its letters; each goes back to
the places it came from, capitals to capitals. The permutation is one to one among values of one shape, so distinct
values get distinct tokens without any table, and the key turns tokens back. Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The longest number a half can be, so that it fits a long.
DIGITS, LETTERS = 36, 26
_ROUNDS = 8
# Letters, and the digits of base 26 as Spark's base conversion spells them.
_ALPHABET, _BASE_26 = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"


def format_preserved(value: Column, key: str | Column) -> Column:
    """The token of a text. NULL stays NULL; single digits and letters are permuted among ten and twenty-six."""
    return _formatted(value, key, forward=True)


def format_restored(value: Column, key: str | Column) -> Column:
    """The text of a token."""
    return _formatted(value, key, forward=False)


def _with(value: Column, result: Callable[[Column], Column]) -> Column:
    """``result`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), result), F.lit(0))


def _formatted(value: Column, key: str | Column, forward: bool) -> Column:
    key = key if isinstance(key, Column) else F.lit(key)
    kinds = F.struct(value.alias("text"), F.regexp_replace(value, "[^0-9]", "").alias("digits"),
                     F.regexp_replace(value, "[^A-Za-z]", "").alias("letters"))
    problem = F.raise_error(F.lit(f"no token of this format beyond {DIGITS} digits or {LETTERS} letters"))

    def token(of: Column) -> Column:
        long = (F.length(of["digits"]) > DIGITS) | (F.length(of["letters"]) > LETTERS)
        letters = F.translate(F.lower(of["letters"]), _ALPHABET, _BASE_26)
        new = F.struct(_permuted(of["digits"], 10, F.concat(key, F.lit("d")), forward).alias("d"),
                       F.translate(_permuted(letters, 26, F.concat(key, F.lit("l")), forward), _BASE_26, _ALPHABET).alias("l"))
        return F.when(long, problem).when(of["text"] == "", of["text"]).otherwise(
            _with(new, lambda signs: _put_back(of["text"], signs)))

    return _with(kinds, token)


def _put_back(text: Column, signs: Column) -> Column:
    """``text`` with the digits and letters of ``signs`` in the places of its own."""

    def put(done: Column, c: Column) -> Column:
        digit, capital, small = c.between("0", "9"), c.between("A", "Z"), c.between("a", "z")
        own = F.substring(signs["l"], done["nl"], F.lit(1))
        sign = F.when(digit, F.substring(signs["d"], done["nd"], F.lit(1))).when(small, own).when(capital, F.upper(own)).otherwise(c)
        return F.struct(F.concat(done["text"], sign).alias("text"), (done["nd"] + digit.cast("int")).alias("nd"),
                        (done["nl"] + (capital | small).cast("int")).alias("nl"))

    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("nd"), F.lit(1).alias("nl"))
    return F.aggregate(F.split(text, ""), start, put, lambda done: done["text"])


def _permuted(text: Column, base: int, key: Column, forward: bool) -> Column:
    """A permutation of the texts of one length over the digits of ``base``; the inverse one if not ``forward``.

    The halves of the text take turns: one moves on by a keyed hash of the other, modulo the number of its texts. A text
    of one digit has an empty half, and is moved on by hashes of that.
    """

    def number(part: Column) -> Column:
        return F.coalesce(F.conv(part, base, 10).cast("bigint"), F.lit(0).cast("bigint")) if base != 10 else F.when(
            part == "", F.lit(0).cast("bigint")).otherwise(part.cast("bigint"))

    def texts(length: Column) -> Column:
        powers = F.array(*(F.lit(base ** i).cast("bigint") for i in range(DIGITS // 2 + 1 if base == 10 else LETTERS // 2 + 1)))
        return F.get(powers, length)

    def padded(half: Column, length: Column) -> Column:
        return F.when(length == 0, "").otherwise(F.lpad(F.lower(F.conv(half.cast("string"), 10, base)), length, F.lit("0")))

    def measured(text: Column) -> Column:
        n = F.length(text)
        left, right = F.floor(n / 2).cast("int"), F.ceil(n / 2).cast("int")
        return F.struct(text.alias("text"), n.alias("n"), left.alias("left"), right.alias("right"), key.alias("key"),
                        texts(left).alias("lefts"), texts(right).alias("rights"))

    def permuted(of: Column) -> Column:
        def step(halves: Column, turn: Column) -> Column:
            # Odd turns move the left half, even ones the right half; the halves change names each time.
            odd = turn % 2 == 1
            hashed = F.conv(F.substring(F.sha2(F.concat_ws("|", of["key"], turn, of["n"], halves["other"]), 256), 1, 15), 16, 10)
            size = F.when(odd, of["lefts"]).otherwise(of["rights"])
            moved = hashed.cast("bigint") % size
            # The sum of two numbers below 10^18 fits a long.
            moved = (halves["moves"] + (moved if forward else size - moved)) % size
            return F.struct(halves["other"].alias("moves"), moved.alias("other"))

        a = number(F.substring(of["text"], F.lit(1), of["left"])).alias
        b = number(F.substring(of["text"], of["left"] + 1, of["right"])).alias
        # As the turns are even in number, the halves end as they began.
        start = F.struct(a("moves"), b("other")) if forward else F.struct(b("moves"), a("other"))
        turns = F.array(*map(F.lit, range(1, _ROUNDS + 1) if forward else range(_ROUNDS, 0, -1)))
        first, second = ("moves", "other") if forward else ("other", "moves")
        return F.when(of["n"] == 0, of["text"]).otherwise(F.aggregate(
            turns, start, step, lambda halves: F.concat(padded(halves[first], of["left"]), padded(halves[second], of["right"]))))

    return _with(text, lambda once: _with(measured(once), permuted))
