"""Joins with any condition, with exact ways around a hot key and around a condition without an equality.

Adaptive execution splits a skewed partition of an inner join on both sides, and of an outer, semi or
anti join on the side that is kept. The other side stays whole, so there one key with a large share of
the rows would end in one task. ``hot_keys`` asks for a plan without that:

* A left, right or full join gets a number besides the key. Keys of the side that can't be split are counted, and of those with
  more rows than a partition's fair share the rows are dealt to several numbers; rows of the other side with
  such a key are copied to each of its numbers. All other rows have number 0. A hot key has rows on the
  side where it was counted, so a copy that met none is no unmatched row and is dropped, told by a tag of that side. The count is part
  of the plan: nothing runs until the result is asked for.
* The right side of a semi or anti join is reduced to the distinct values the condition looks at, which
  collapses copies before the shuffle. A right column that is compared besides the key stays next to it, so
  then a key is only reduced to its distinct combinations.

A condition is best given as a list: each part on one side alone then becomes a filter below where the join type
allows that. A text is taken apart at its ANDs if it has no OR. Where no part is an equality of a left and a right
expression of one plain type, there is no key to deal by, and Spark's own join is used.

Without any equality Spark compares all rows with all others. If the parts hold an expression of one side between
two of the other, the join is a band join instead. The values of the single side are cut into ranges of about
equally many rows. A row lies in one range and an interval in every range that it touches, so ranges are joined by equality,
the condition is tested on what meets, and each pair meets once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.relational import unused

#: The square root of the number of ranges of a band join.
BAND_ROOT = 32
_BUCKETS = 16
_KEEPS_LEFT = {"left", "left_outer", "full", "outer", "full_outer"}
_KEEPS_RIGHT = {"right", "right_outer", "full", "outer", "full_outer"}
_LEFT_ONLY = {"semi", "left_semi", "anti", "left_anti"}
_INNER = {"inner"}
_WHOLE = {"tinyint", "smallint", "int", "bigint"}
_COMPARED = re.compile(r"(?P<a>[^<>=!]+)(?P<sign><=|>=|<|>|=)(?P<b>[^<>=!]+)")
_BETWEEN = re.compile(r"\s*(?P<x>.+?)\s+between\s+(?P<low>.+?)\s+and\s+(?P<high>.+)", re.IGNORECASE | re.DOTALL)
_RANGED = re.compile(r"[<>](?!=>)|\bbetween\b", re.IGNORECASE)
_MIRRORED = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}


def join_name(join_type: str) -> str:
    """Spark's name for a join type such as ``"LEFT OUTER"`` or ``"CROSS JOIN"``."""
    words = join_type.lower().split()
    if words and words[-1] == "join":
        words.pop()
    return "_".join(words) or "inner"


def join(
    left: DataFrame,
    right: DataFrame,
    join_type: str = "inner",
    condition: str | Sequence[str] | None = None,
    hot_keys: bool = False,
) -> DataFrame:
    """Join on any boolean expression, or on all of several. A cross join takes none; every other join needs one.

    With ``hot_keys`` the dealt side's rows are told apart by a hash of all their columns, so select what is needed first.
    """
    how = join_name(join_type)
    if how == "cross":
        if condition is not None:
            raise ValueError("a cross join takes no condition")
        return left.crossJoin(right)
    given = [condition] if isinstance(condition, str) else list(condition or ())
    if not given:
        raise ValueError(f"a {join_type} join needs a condition")
    plain = left.join(right, F.expr(_all(given)), how)
    known = _INNER | _LEFT_ONLY | _KEEPS_LEFT | _KEEPS_RIGHT
    ranged = _RANGED.search(" ".join(given))
    if how not in known or not (ranged or hot_keys and how not in _INNER):
        return plain
    left, right = _Side(left), _Side(right)
    parts = [part for text in given for part in _taken_apart(left, right, text)]
    if hot_keys and how in _LEFT_ONLY:
        return _with_distinct_right(left.df, right, how, parts, left)
    if hot_keys and how not in _INNER and (keys := _keys(left, right, parts)):
        return _dealt(left, right, how, parts, keys)
    if ranged and not any(_sides(left, right, part) for part in parts):
        return _band(left, right, how, parts) or plain
    return plain


class _Side:
    """One input, and what it has answered about expressions so far."""

    def __init__(self, df: DataFrame) -> None:
        self.df, self._kinds = df, {}

    def kind(self, expression: str) -> str | None:
        """The type of an expression, None where the input can't answer it."""
        if expression not in self._kinds:
            try:
                self._kinds[expression] = self.df.select(F.expr(expression)).dtypes[0][1]
            except (AnalysisException, IndexError):
                self._kinds[expression] = None
        return self._kinds[expression]

    def has(self, expression: str) -> bool:
        return self.kind(expression) is not None


def _all(parts: Sequence[str]) -> str:
    return " AND ".join(f"({part})" for part in parts)


def _taken_apart(left: _Side, right: _Side, text: str) -> list[str]:
    """The parts of a text that must hold together; the text itself where that is not certain."""
    pieces = re.split(r"\band\b", text, flags=re.IGNORECASE)
    if len(pieces) == 1 or re.search(r"\b(or|case|not)\b", text, flags=re.IGNORECASE):
        return [text]
    both, parts, open_piece = _Side(left.df.crossJoin(right.df)), [], ""
    for piece in pieces:
        # A piece cut at the AND of a BETWEEN or within quotes is no condition until its rest is there.
        open_piece = f"{open_piece}AND{piece}" if open_piece else piece
        if both.kind(open_piece) == "boolean":
            parts.append(open_piece.strip())
            open_piece = ""
    return [text] if open_piece else parts


def _compared(part: str) -> tuple[str, str, str] | None:
    """Both expressions and the sign of a plain comparison."""
    found = _COMPARED.fullmatch(part)
    return (found["a"].strip(), found["sign"], found["b"].strip()) if found else None


def _sides(left: _Side, right: _Side, part: str) -> tuple[str, str] | None:
    """The left and the right expression of an equality between the two sides."""
    found = _compared(part)
    if not found or found[1] != "=":
        # A null-safe equality is a key for Spark as well.
        safe = part.split("<=>")
        if len(safe) != 2:
            return None
        found = (safe[0], "<=>", safe[1])
    a, _, b = found
    if left.has(a) and right.has(b) and not (right.has(a) or left.has(b)):
        return a, b
    if left.has(b) and right.has(a) and not (right.has(b) or left.has(a)):
        return b, a
    return None


def _keys(left: _Side, right: _Side, parts: list[str]) -> list[tuple[str, str, str]]:
    """(left expression, right expression, type) of the equalities whose two sides have equal hashes where they are equal."""
    keys = []
    for part in parts:
        sides = None if "<=>" in part else _sides(left, right, part)
        if sides:
            a, b = left.kind(sides[0]), right.kind(sides[1])
            whole = {a, b} <= _WHOLE
            if whole or (a == b and (a in ("string", "date", "timestamp", "timestamp_ntz", "boolean", "binary") or a.startswith("decimal"))):
                keys.append((*sides, "bigint" if whole else a))
    return keys


def _with_distinct_right(left: DataFrame, right_side: _Side, how: str, parts: list[str], left_side: _Side) -> DataFrame:
    own = [part for part in parts if right_side.has(part) and not left_side.has(part)]
    right = right_side.df
    for part in own:
        right = right.filter(F.expr(part))
    rest = [part for part in parts if part not in own]
    if not rest:
        return left.join(right.limit(1), F.lit(True), how)
    columns = right.columns
    if len(set(columns)) == len(columns):
        # A column is looked at if the rest can't be resolved without it.
        text = _all(rest)
        looked_at = [c for c in columns if c.lower() in text.lower() and not _Side(left.crossJoin(right.drop(c))).has(text)]
        kinds = dict(right.dtypes)
        if looked_at and not any("map<" in kinds[c] or "variant" in kinds[c] for c in looked_at):
            values = [F.col(f"`{c}`") for c in looked_at]
            # With their hash as one more column, the distinct values do not lie by the join key yet. So the
            # join shuffles them itself, and only then may Spark split a hot key of the left side.
            name = unused([*left.columns, *columns])
            right = right.select(*values, F.xxhash64(*values).alias(name)).distinct().select(*values)
    return left.join(right, F.expr(_all(rest)), how)


def _row_hash(df: DataFrame) -> Column:
    names = [name.lower() for name in df.columns]
    usable = [name for name, kind in df.dtypes if names.count(name.lower()) == 1 and "map<" not in kind and "variant" not in kind]
    return F.xxhash64(*[F.col(f"`{name}`") for name in usable]) if usable else F.lit(0).cast("bigint")


def _key_hash(expressions: Sequence[str], kinds: Sequence[str]) -> Column:
    return F.xxhash64(*[F.expr(e).cast(kind) for e, kind in zip(expressions, kinds)])


def _hot(side: DataFrame, known: Column, key: Column, parts: int) -> DataFrame:
    """One row, one map: of each key hash with more rows than a partition's share, how many shares it has.

    Each has more than one of ``parts`` shares, so there are fewer of them than partitions. Should two fall in
    one bucket, the lesser stays as it is, which costs time only.
    """
    counts = side.where(known).select(key.alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # The most frequent key of each of many buckets, and all rows, in one pass.
    tops = counts.groupBy(F.pmod("key", F.lit(_BUCKETS * parts))).agg(F.max(F.struct("n", "key")).alias("top"), F.sum("n").alias("rows"))
    hot = tops.agg(F.collect_list("top").alias("tops"), F.sum("rows").alias("total"))
    shares = F.transform("tops", lambda t: F.struct(t["key"].alias("key"), F.ceil(t["n"] * parts / F.col("total")).cast("int").alias("shares")))
    return hot.select(F.map_from_entries(F.filter(shares, lambda t: t["shares"] > 1)))


def _dealt(left: _Side, right: _Side, how: str, parts: list[str], keys: list[tuple[str, str, str]]) -> DataFrame:
    """An outer join on the key and a number by which rows of hot keys are dealt and copied."""
    mark = unused([*left.df.columns, *right.df.columns, *parts])
    sides = {"left": left.df, "right": right.df}
    only = {
        "left": [p for p in parts if left.has(p) and not right.has(p)],
        "right": [p for p in parts if right.has(p) and not left.has(p)],
    }
    kept = {"left": how in _KEEPS_LEFT, "right": how in _KEEPS_RIGHT}
    for side in sides:
        # Rows that the side's own conditions rule out show only where their side is kept.
        if not kept[side]:
            for part in only[side]:
                sides[side] = sides[side].filter(F.expr(part))
    equalities = [p for p in parts if "<=>" not in p and _sides(left, right, p) and any(k[:2] == _sides(left, right, p) for k in keys)]
    mixed = [p for p in parts if p not in equalities and p not in only["left"] and p not in only["right"]]
    kinds = [kind for _, _, kind in keys]
    columns = {"left": [a for a, _, _ in keys], "right": [b for _, b, _ in keys]}
    may, key, shares, spread = {}, {}, {}, int(left.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for side in sides:
        may[side] = F.coalesce(F.expr(_all([*(f"({c}) IS NOT NULL" for c in columns[side]), *only[side]])), F.lit(False))
        key[side] = _key_hash(columns[side], kinds)
    other = {"left": "right", "right": "left"}
    # Spark itself splits the kept side of a left or right join.
    counted = [side for side in sides if not kept[side]] or list(sides)
    for side in counted:
        shares[side] = _hot(sides[side], may[side], key[side], spread)

    def asked(side: str, of: str) -> Column:
        """In how many numbers the counts of side ``of`` divide the key of a row on ``side``; 1 if it is not hot there."""
        own = F.coalesce(F.try_element_at(shares[of].scalar(), key[side]), F.lit(1))
        if len(counted) == 1:
            return own
        # Hot on both sides: the side with more rows is dealt, the other is copied.
        rival = F.coalesce(F.try_element_at(shares[other[of]].scalar(), key[side]), F.lit(1))
        return F.when((own > rival) | ((own == rival) & F.lit(of == "right")), own).otherwise(1)

    numbered = {}
    for side, df in sides.items():
        number, copies = F.lit(0), F.lit(1)
        if side in counted:
            number = F.pmod(_row_hash(df), asked(side, side)).cast("int")
        if other[side] in counted:
            copies = F.when(may[side], asked(side, other[side])).otherwise(1)
        if kept[side] and side in counted:
            # Rows that can't match are many where the key is null; they go anywhere.
            number = F.when(may[side], number).otherwise(F.pmod(_row_hash(df), F.lit(spread)).cast("int"))
        df = df.select("*", number.alias(f"{mark}n"), copies.alias(f"{mark}{side}_copies"), F.lit(True).alias(f"{mark}{side}"))
        if other[side] in counted:
            to = F.sequence(F.lit(0), F.col(f"{mark}{side}_copies") - 1)
            df = df.select("*", F.explode(F.when(F.col(f"{mark}{side}_copies") > 1, to).otherwise(F.array(f"{mark}n"))).alias(f"{mark}{side}_n"))
        else:
            df = df.withColumnRenamed(f"{mark}n", f"{mark}{side}_n")
        numbered[side] = df.drop(f"{mark}n")
    on = [*parts, f"{mark}left_n = {mark}right_n"]
    joined = numbered["left"].join(numbered["right"], F.expr(_all(on)), how)
    for side in sides:
        if kept[side] and other[side] in counted:
            joined = joined.where(~((F.col(f"{mark}{side}_copies") > 1) & F.col(f"{mark}{other[side]}").isNull()))
    result = joined.drop(*[f"{mark}{side}{rest}" for side in sides for rest in ("", "_n", "_copies")])
    if mixed:
        # Here a row may have met its key and still match nothing. Of the rows that were copied these are found by themselves.
        for side in sides:
            if kept[side] and other[side] in counted:
                copied = sides[side].where(may[side] & (asked(side, other[side]) > 1))
                unmatched = _with_distinct_right(copied, {"left": left, "right": right}[other[side]], "left_anti", parts, {"left": left, "right": right}[side])
                nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in sides[other[side]].schema.fields]
                result = result.union(unmatched.select("*", *nulls) if side == "left" else unmatched.select(*nulls, "*"))
    return result


def _intervals(left: _Side, right: _Side, parts: list[str]) -> tuple[str, str, str, str] | None:
    """The side that has single values, the value, and the lower and upper bounds of the other side, as texts."""
    bounds: dict[tuple[str, str], dict[str, str]] = {}
    for part in parts:
        between = _BETWEEN.fullmatch(part)
        found = [(between["x"], ">=", between["low"]), (between["x"], "<=", between["high"])] if between else [_compared(part)]
        for a, sign, b in filter(None, found):
            if sign not in _MIRRORED:
                continue
            for x, sign_of_x, bound in ((a, sign, b), (b, _MIRRORED[sign], a)):
                for name, own, far in (("left", left, right), ("right", right, left)):
                    if own.has(x) and not far.has(x) and far.has(bound) and not own.has(bound):
                        bounds.setdefault((name, x.strip()), {})["low" if sign_of_x[0] == ">" else "high"] = bound
    # Only an expression that is bounded on both ends makes a band.
    return next(((name, x, b["low"], b["high"]) for (name, x), b in bounds.items() if len(b) == 2), None)


def _as_number(side: _Side, expression: str) -> Column | None:
    """The expression as a double that never falls where the value rises."""
    kind = side.kind(expression) or ""
    if kind in _WHOLE or kind in ("float", "double") or kind.startswith("decimal"):
        return F.expr(expression).cast("double")
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.expr(expression).cast("timestamp").cast("double")
    return None


def _ranges(points: DataFrame, value: Column, root: int, mark: str) -> tuple[Column, Callable[[Column], Column]]:
    """A column of borders that a side takes on, and with it the number of the range that a value of it lies in.

    Borders are quantiles of ``points``. A value is looked up among every ``root``-th of them, then among those between.
    """
    at = [k / root**2 for k in range(1, root**2)]
    borders = points.agg(F.percentile_approx(value, at, 10 * root**2).alias("all"))
    every = F.transform(F.sequence(F.lit(1), F.lit(root - 1)), lambda k: F.try_element_at("all", (k * root).cast("int")))
    borders = borders.select(F.struct("all", every.alias("every"))).scalar().alias(f"{mark}b")
    every, whole = F.col(f"{mark}b.every"), F.col(f"{mark}b.all")

    def number(x: Column) -> Column:
        above = F.size(F.filter(every, lambda b: b <= x))
        below = F.slice(whole, above * root + 1, root - 1)
        return F.when(x.isNotNull() & whole.isNotNull(), above * root + F.size(F.filter(below, lambda b: b <= x))).otherwise(0)

    return borders, number


def _band(left: _Side, right: _Side, how: str, parts: list[str]) -> DataFrame | None:
    """A join whose condition holds an expression of one side between two of the other; None where there is no such."""
    found = _intervals(left, right, parts)
    if not found:
        return None
    single, x, low, high = found
    # An interval has copies, so only the other side may be kept.
    keeps = {side for side, types in (("left", _KEEPS_LEFT | _LEFT_ONLY), ("right", _KEEPS_RIGHT)) if how in types}
    if keeps - {single}:
        return None
    points, spans = (left, right) if single == "left" else (right, left)
    values = [_as_number(points, x), _as_number(spans, low), _as_number(spans, high)]
    if any(v is None for v in values):
        return None
    mark = unused([*left.df.columns, *right.df.columns, *parts])
    borders, number = _ranges(points.df, values[0], BAND_ROOT, mark)
    points = points.df.select("*", borders).select("*", number(values[0]).alias(f"{mark}p")).drop(f"{mark}b")
    spans = spans.df.where(values[1] <= values[2]).select("*", borders)
    spans = spans.select("*", F.explode(F.sequence(number(values[1]), number(values[2]))).alias(f"{mark}s")).drop(f"{mark}b")
    left, right = (points, spans) if single == "left" else (spans, points)
    on = _all([*parts, f"{mark}p = {mark}s"])
    return left.join(right, F.expr(on), how).drop(f"{mark}p", f"{mark}s")
