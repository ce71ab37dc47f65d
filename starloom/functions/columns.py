"""Column expressions: epoch time, calendar parts, casts and sentinels.

All of them are built-in JVM expressions and none depends on the session time
zone: instants are handled as zone-less timestamps counted from the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
WIDE = "decimal(38,18)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_timestamp(millis: Column | str) -> Column:
    """Epoch milliseconds to a zone-less timestamp, cut to whole seconds."""
    seconds = F.call_function("div", _col(millis).cast("bigint"), F.lit(1000))
    return F.expr(EPOCH) + seconds * F.expr("interval '1' second")


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds from the epoch to a zone-less timestamp."""
    since = (_col(ts) - F.expr(EPOCH)).cast("interval second")
    return (since.cast("decimal(20,6)") * 1000000).cast("bigint")


def calendar_parts(df: DataFrame, ts_col: str) -> DataFrame:
    """Add hour, day, ISO week, month, calendar year and weekday (Sunday = 0)."""
    ts = F.col(ts_col)
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day": F.dayofmonth(ts),
            "week": F.weekofyear(ts),
            "month": F.month(ts),
            "year": F.year(ts),
            "weekday": F.dayofweek(ts) - 1,
        }
    )


def truncate_decimal(
    value: Column, scale: int = 0, source: T.DataType = T.StringType(), precision: int = 18
) -> Column:
    """Cut a number toward zero to ``scale`` digits; a plain cast would round.

    Text is cut as text, whatever its length and notation. Up to 18 digits, numbers and short
    plain texts take shorter ways: whole ones go through a 64-bit integer, which cuts by itself,
    and binary floats get there without a detour over wide decimals.
    """
    target = f"decimal({precision},{scale})"
    if isinstance(source, T.StringType):
        exact = _cut_text(value, scale).try_cast(target)
        if precision > 18:
            return exact
        # Too short for a digit that the detour would lose, and without an exponent.
        text = F.trim(value, F.lit(WHITE))
        plain = (F.length(text) <= 18) & text.rlike(r"^[+-]?[0-9]*\.?[0-9]*$")
        return F.when(plain, _cut_number(text, scale, target)).otherwise(exact)
    if isinstance(source, T.IntegralType):
        return value.try_cast(target)
    if isinstance(source, T.DecimalType):
        return (_toward_zero(value, scale) if source.scale > scale else value).try_cast(target)
    if precision > 18 or scale:  # a binary number of at most 17 digits
        return _cut_text(value.cast("string"), scale).try_cast(target)
    return value.try_cast("bigint").try_cast(target)


def _toward_zero(value: Column, scale: int) -> Column:
    return F.when(value < 0, F.ceil(value, F.lit(scale))).otherwise(F.floor(value, F.lit(scale)))


def _cut_number(value: Column, scale: int, target: str) -> Column:
    wide = value.try_cast(WIDE)
    return (wide.try_cast("bigint") if scale == 0 else _toward_zero(wide, scale)).try_cast(target)


#: What may stand around a number.
WHITE = " \t\n\r\f\x0b"
#: A number in plain notation, and sign, digits before and after the point, exponent of any.
PLAIN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
NUMBER = r"^([+-]?)(?=\.?[0-9])([0-9]*)\.?([0-9]*)[eE]([+-]?[0-9]+)$"
#: More places than any decimal has: what lies beyond is out of range, or 0.
_PLACES = 100
_FAR = 999_999_999


def _cut_text(value: Column, scale: int) -> Column:
    """A number's text in plain notation with at most ``scale`` digits after the point, the
    others cut off; NULL if it is no number. No digit goes through a type that could round or
    overflow."""
    text = F.trim(value, F.lit(WHITE))
    padded = F.regexp_replace(text, r"^([+-]?)\.", "$10.")
    pattern, kept = (r"\.[0-9]*$", "") if scale == 0 else (rf"(\.[0-9]{{{scale}}})[0-9]+$", "$1")
    return F.when(text.rlike(PLAIN), F.regexp_replace(padded, pattern, kept)).when(
        text.rlike(NUMBER), _moved(text, scale)
    )


def _moved(text: Column, scale: int) -> Column:
    """A number with an exponent in plain notation: the point is moved within the digits.

    More than 100 places before the point are cut to 100, which no decimal holds either. Each
    step is bound to a name by an array of one, so that it is computed once.
    """
    # Sign, digits before and after the point, exponent.
    fields = F.split(F.regexp_replace(text, NUMBER, "$1,$2,$3,$4"), ",")
    # An exponent of very many digits is as good as one of nine.
    power = f"""greatest(-{_FAR}, least({_FAR},
        coalesce(try_cast(p[3] AS int), if(startswith(p[3], '-'), -{_FAR}, {_FAR}))))"""
    number = f"""p -> named_struct('sign', p[0], 'digits', ltrim('0', concat(p[1], p[2])),
        'point', {power} - length(p[2]))"""
    # Digits before the point; if negative, zeros behind it.
    place = "n -> named_struct('sign', n.sign, 'digits', n.digits, 'point', n.point + length(n.digits))"
    before = f"if(n.point > 0, rpad(n.digits, least(n.point, {_PLACES}), '0'), '0')"
    zeros = f"repeat('0', greatest(0, least(-n.point, {_PLACES})))"
    behind = f"substring(concat({zeros}, substring(n.digits, greatest(n.point, 0) + 1, {scale})), 1, {scale})"
    plain = f"concat(n.sign, {before}, '.', {behind}, '0')" if scale else f"concat(n.sign, {before})"
    steps = F.array(fields)
    for step in (number, place, f"n -> if(n.digits = '', '0', {plain})"):
        steps = F.call_function("transform", steps, F.expr(step))
    return F.element_at(steps, 1)


def safe_cast(
    column: Column | str,
    source: T.DataType,
    target: T.DataType | str,
    decimal_scale: int = 0,
    strict: bool = False,
) -> Column:
    """Cast to ``target``; blank text is NULL, and so is unreadable text unless
    ``strict``, which fails the job on it.

    A bare ``"decimal"`` target means 18 digits with ``decimal_scale`` of them
    after the point, the rest cut off.
    """
    value = _col(column)
    name = target if isinstance(target, str) else target.simpleString()
    if name == "string":
        return value.cast("string")
    text = isinstance(source, T.StringType)
    present = F.nullif(F.trim(value), F.lit("")) if text else value
    if name == "decimal":
        result = truncate_decimal(present, decimal_scale, source)
    elif name.startswith("decimal("):
        digits, scale = map(int, name[len("decimal(") : -1].split(","))
        result = truncate_decimal(present, scale, source, max(18, digits)).try_cast(name)
    elif not text and isinstance(source, T.FractionalType) and name in ("int", "bigint"):
        result = truncate_decimal(present, 0, source).try_cast(name)
    else:
        result = present.try_cast(name)
    if not strict:
        return result
    message = F.concat(F.lit(f"value does not fit {name}: "), present.cast("string"))
    kind = f"decimal(18,{decimal_scale})" if name == "decimal" else name
    # The value is computed once; the text is looked at again only where that gave NULL.
    return F.coalesce(result, F.when(present.isNotNull(), F.raise_error(message).cast(kind)))


def null_if_sentinel(df: DataFrame, column: str, value=0) -> DataFrame:
    """Replace the value that stands for 'unknown' by NULL."""
    return df.withColumn(column, F.nullif(F.col(column), F.lit(value)))
