"""Joins with explicit null rules, written so that a hot key can be split.

Adaptive execution splits a hot partition of an inner, left outer, semi or anti join when both inputs come straight from
a shuffle.  It cannot when an input was already partitioned by the join key (the result of a ``distinct`` or ``groupBy`` on
it, or of an earlier join), on the right of a left outer join, or in a full outer join.  Therefore:

* joins here run on two helper columns made from the key, so both inputs are always shuffled for the join;
* in a full outer join, and in a left outer join to a side with hot keys, the rows of the keys that a sketch finds hot are
  dealt over salts;
* keys of different types are brought to the type in which Spark's own ``=`` compares them, before they are hashed;
* rows with a null key, which match nothing, are spread over all tasks;
* an OR of two equalities, which would plan as a nested loop, becomes two inner joins and two anti joins.

Nothing is forced to broadcast; Spark does it by itself when the measured size of a side is under its threshold.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import clean_symbol

# Helper columns that stand for a key: a hash that sorts and compares fast, and the exact values behind it.
ROW_KEY = ["_hash", "_key"]


KeyTypes = list[T.DataType | None]


def common_types(left_df: DataFrame, right_df: DataFrame, left_on: list[str], right_on: list[str]) -> KeyTypes:
    """For each pair of key columns the type to compare them in; None where they agree.

    Numbers are widened, as are dates and stamps; a text meets any other type as that type (a text that is no such value
    matches nothing).  Other mixtures are an error.
    """
    return [
        None if (a := left_df.schema[x].dataType) == (b := right_df.schema[y].dataType) else _common(left_df, x, a, y, b)
        for x, y in zip(left_on, right_on, strict=True)
    ]


def _common(df: DataFrame, x: str, a: T.DataType, y: str, b: T.DataType) -> T.DataType:
    for kinds in ((T.NumericType,), (T.DateType, T.TimestampType, T.TimestampNTZType)):
        if isinstance(a, kinds) and isinstance(b, kinds):
            pair = df.sparkSession.createDataFrame([], T.StructType([T.StructField("a", a), T.StructField("b", b)]))
            return pair.select(F.coalesce("a", "b").alias("c")).schema["c"].dataType
    texts = [isinstance(t, (T.StringType, T.CharType, T.VarcharType)) for t in (a, b)]
    other = b if texts[0] else a
    if all(texts):
        return T.StringType()
    if any(texts) and isinstance(other, T.AtomicType):
        return other
    raise TypeError(f"keys {x} ({a.simpleString()}) and {y} ({b.simpleString()}) have no common type")


def keyed(df: DataFrame, columns: list[str], spread_nulls: bool = False, types: KeyTypes | None = None) -> DataFrame:
    """Add a join key over several columns in which null equals null (as fields of a struct do).

    With ``spread_nulls`` rows that miss a part of the key get a hash of the whole row instead, for joins in which they
    match nothing.  ``types`` are those of ``common_types``; the columns themselves keep theirs.
    """
    values = []
    for c, kind in zip(columns, types or [None] * len(columns), strict=True):
        own = F.col(f"`{c}`")
        if kind is None:
            values.append(own.alias(c))
            continue
        same = own.try_cast(kind)
        # a text that is no value of the type equals nothing, not even a null
        values += [same.alias(c), (own.isNotNull() & same.isNull()).alias(f"{c}_odd")]
    hashed = F.xxhash64(*values)
    if spread_nulls:
        whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])
        hashed = F.when(_any_null(columns), whole).otherwise(hashed)
    return df.withColumns({"_hash": hashed, "_key": F.struct(*values)})


def _any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns])


def keys_of(df: DataFrame, columns: list[str], types: KeyTypes | None = None) -> DataFrame:
    """The distinct keys of a frame; copies are folded before they are shuffled."""
    keys = keyed(df.select(*columns).distinct(), columns, types=types).select(*ROW_KEY)
    return keys.distinct() if any(types or []) else keys


def _present(df: DataFrame, on: list[str]) -> DataFrame:
    return df.where(~_any_null(on))


def _listed(on: list[str] | str) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def suffix_clashes(df: DataFrame, clashes: set[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c in clashes})


def _suffixed(left_df: DataFrame, right_df: DataFrame, on: list[str], suffixes: tuple[str, str]):
    clashes = (set(left_df.columns) & set(right_df.columns)) - set(on)
    return suffix_clashes(left_df, clashes, suffixes[0]), suffix_clashes(right_df, clashes, suffixes[1])


def inner(left_df: DataFrame, right_df: DataFrame, on: list[str] | str, suffixes=("", "_right")) -> DataFrame:
    """Inner join on equal, non-null keys; clashing columns get suffixes."""
    on = _listed(on)
    a, b = _suffixed(left_df, right_df, on, suffixes)
    types = common_types(a, b, on, on)
    b = keyed(_present(b, on), on, types=types).drop(*on)
    return keyed(_present(a, on), on, types=types).join(b, ROW_KEY, "inner").drop(*ROW_KEY)


def left(
    left_df: DataFrame, right_df: DataFrame, on: list[str] | str, suffixes=("", "_right"), hot_right: bool = False, distinct: bool = False
) -> DataFrame:
    """Left join on equal, non-null keys; clashing columns get suffixes.

    A hot key on the left is split.  Say ``hot_right`` when a key may hold a large part of a large right side: rows of its hot
    keys are then dealt over salts, for a second look at its keys (see ``full_outer``).  With ``distinct`` each row comes out once;
    equal rows have the same key and salt, so they are found in the task that joined them.
    """
    on = _listed(on)
    a, b = _suffixed(left_df, right_df, on, suffixes)
    types = common_types(a, b, on, on)
    a, others = keyed(a, on, True, types), keyed(_present(b, on), on, types=types).drop(*on)
    if not hot_right:
        return _once(a.join(others, ROW_KEY, "left"), ROW_KEY, distinct)
    keys = [keyed(_present(side.select(*on), on), on, types=types).select("_hash") for side in (a, b)]
    # rows that are compared afterwards stay where the join puts them, so a hot key on the left is dealt over salts as well
    hot = hot_keys(*keys) if distinct else hot_keys(keys[1], None).withColumn("_side", F.lit(1))
    x, y = salted(a, hot, 0, ~_any_null(on)), salted(others, hot, 1).drop("_again").withColumn("_in_b", F.lit(True))
    joined = x.join(y, [*ROW_KEY, "_salt"], "left")
    return _once(joined.where(~(F.col("_again") & F.col("_in_b").isNull())).drop("_again", "_in_b"), [*ROW_KEY, "_salt"], distinct)


def _once(joined: DataFrame, helpers: list[str], distinct: bool) -> DataFrame:
    """Joined rows without the columns they met on, and without copies where asked; these share all helper columns."""
    return (joined.distinct() if distinct else joined).drop(*helpers)


def left_folded(left_df: DataFrame, right_df: DataFrame, on: list[str] | str) -> DataFrame:
    """Left join to a side that may hold many copies of a row: they are counted before the shuffle and put back after."""
    on = _listed(on)
    folded = right_df.groupBy(*right_df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    joined = left(left_df, folded, on)
    copies = F.sequence(F.lit(1).cast("long"), F.coalesce("_copies", F.lit(1).cast("long")))
    return joined.withColumn("_copy", F.explode(copies)).drop("_copies", "_copy")


def natural_left(left_df: DataFrame, right_df: DataFrame) -> DataFrame:
    """Left join on every column the two frames share."""
    return left(left_df, right_df, [c for c in left_df.columns if c in right_df.columns])


def semi(left_df: DataFrame, right_df: DataFrame, on: list[str] | str) -> DataFrame:
    """The left rows whose key the right has; null keys match nothing."""
    on = _listed(on)
    types = common_types(left_df, right_df, on, on)
    known = keys_of(_present(right_df, on), on, types)
    return keyed(_present(left_df, on), on, types=types).join(known, ROW_KEY, "left_semi").drop(*ROW_KEY)


def only_in_left(left_df: DataFrame, right_df: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Set difference by key.  With ``null_safe`` a null key on the right removes null keys on the left."""
    types = common_types(left_df, right_df, on, on)
    if null_safe:
        return keyed(left_df, on, types=types).join(keys_of(right_df, on, types), ROW_KEY, "left_anti").drop(*ROW_KEY)
    known = keys_of(_present(right_df, on), on, types)
    return keyed(left_df, on, True, types).join(known, ROW_KEY, "left_anti").drop(*ROW_KEY)


def add_only_new(base: DataFrame, extra: DataFrame, symbol: str = "ticker", null_safe: bool = True) -> DataFrame:
    """The rows of ``extra`` whose cleaned symbol the base does not have yet."""
    key = "_symbol"
    known = base.select(clean_symbol(symbol).alias(key))
    return only_in_left(extra.withColumn(key, clean_symbol(symbol)), known, [key], null_safe).drop(key)


def first_known(
    frames: list[DataFrame], symbol: str = "ticker", stage: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Stack frames in which each only adds symbols that no earlier one has; rows without a symbol count as one symbol.

    The same rows as repeated ``add_only_new``, but each frame is read twice however many there are: once for the smallest
    frame number of each symbol, once for its rows.  The rows of the first frame all stay, so they are not shuffled.  ``stage``
    may store the frames (see ``sources.writers.staged``), so that both times they are read and not worked out again.
    """
    from .columns import stack

    if stage:
        frames = [stage(f, f"frame-{i}") for i, f in enumerate(frames)]

    pair = ["_symbol", "_frame"]
    numbered = [f.withColumns({"_frame": F.lit(i), "_symbol": clean_symbol(symbol)}) for i, f in enumerate(frames)]
    symbols = stack([f.select(*pair) for f in numbered])
    first = keyed(symbols.groupBy("_symbol").agg(F.min("_frame").alias("_frame")), pair).select(*ROW_KEY)
    # one row per symbol, so the inner join keeps rows as a semi join would; a semi join would be repeated for every frame
    added = keyed(stack(numbered[1:]), pair).join(first, ROW_KEY, "inner").drop(*ROW_KEY, *pair)
    return stack([frames[0], added])


#: A key is hot if it holds one row of so many of its side, and as many frequent keys a side are looked for.
HOT_SHARE, HOT_KEYS = 64, 64


def hot_keys(left_keys: DataFrame, right_keys: DataFrame | None, share: int = HOT_SHARE, most: int = HOT_KEYS) -> DataFrame:
    """``_hash, _side, _salts`` of the hot keys of frames with a column ``_hash``: the side that has many rows of the key (0 left,
    1 right; left if both do), and in how many parts to deal them.

    One sketch of bounded size a side, combined before the shuffle; ``most`` rows a side at most come out.  A key that is found
    does occur on its side, which ``salted`` relies on; one that is missed only stays in one piece.
    """
    sides = []
    for number, keys in enumerate([left_keys, right_keys]):
        if keys is not None:
            sketch = keys.agg(F.expr(f"approx_top_k(_hash, {most}, {most * 64})").alias("_top"), F.count(F.lit(1)).alias("_rows"))
            sides.append(sketch.select("_rows", F.lit(number).alias("_side"), F.inline("_top")))
    found = reduce(lambda x, y: x.unionByName(y), sides).where(F.col("count") * share >= F.col("_rows"))
    salts = F.ceil(F.col("count") * share / F.col("_rows")).cast("int")
    picked = found.groupBy(F.col("item").alias("_hash")).agg(F.min(F.struct(F.col("_side"), salts.alias("_salts"))).alias("_hot"))
    return picked.select("_hash", "_hot.*").where("_salts > 1")


def salted(df: DataFrame, hot: DataFrame, side: int, present: Column | None = None) -> DataFrame:
    """``df`` with ``_salt``, and ``_again`` for rows that stand once for each salt.

    Rows of a key that is hot on their own side are dealt over its salts by a hash; rows of a key that is hot on the other side
    are repeated for each of them, so that every pair meets once.  ``present`` tells which rows have a key at all: the others'
    hash is that of a whole row and may be that of a key by chance, or where the row holds nothing else.
    """
    known = df.join(F.broadcast(hot), "_hash", "left")  # a bounded number of rows
    if present is not None:
        known = known.withColumn("_side", F.when(present, F.col("_side")))
    others = F.coalesce(F.col("_side") != side, F.lit(False))
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    own = F.when(F.col("_side") == side, F.pmod(whole, F.col("_salts")).cast("int")).otherwise(F.lit(0))
    salts = F.when(others, F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(own))
    return known.select(*df.columns, others.alias("_again"), F.explode(salts).alias("_salt"))


def full_outer(
    left_df: DataFrame, right_df: DataFrame, on: list[str] | str, suffixes=("_left", "_right"), unique: bool = False
) -> DataFrame:
    """Full outer join; null keys never match.  Clashing columns get suffixes.

    Each side is read once, and its keys once more for a sketch of the hot ones.  Adaptive execution never splits a full outer join,
    so rows of a hot key are dealt over several salts and the other side's rows of that key repeated for each.  A repeated row
    that finds no partner under one salt has one under another, as the key does occur on the side it is hot on, so it is dropped.
    Say ``unique`` where no key repeats on either side: then nothing is looked for.  Keys of different types come out in the common one, or as text where one side's are.
    """
    on = _listed(on)
    a, b = _suffixed(left_df, right_df, on, suffixes)
    types = common_types(a, b, on, on)
    shown = {c: T.StringType() if _is_text(a, c) or _is_text(b, c) else t for c, t in zip(on, types, strict=True) if t}
    lefts, rights = keyed(a, on, True, types), keyed(b, on, True, types)
    if unique:
        x, y = (k.withColumns({"_again": F.lit(False), "_salt": F.lit(0)}) for k in (lefts, rights))
    else:
        hot = hot_keys(*[keyed(_present(x.select(*on), on), on, types=types).select("_hash") for x in (a, b)])
        x, y = (salted(k, hot, n, ~_any_null(on)) for n, k in enumerate((lefts, rights)))
    x, y = _never_equal(x, on), _never_equal(y, on)
    y = y.select(*ROW_KEY, "_salt", F.col("_again").alias("_again_b"), *[F.col(f"`{c}`").alias(f"_on_{i}") for i, c in enumerate(on)], F.lit(True).alias("_in_b"), *[c for c in b.columns if c not in on])
    joined = x.withColumn("_in_a", F.lit(True)).join(y, [*ROW_KEY, "_salt"], "full_outer")
    lone = (F.col("_again") & F.col("_in_b").isNull()) | (F.col("_again_b") & F.col("_in_a").isNull())
    kept = joined.where(~F.coalesce(lone, F.lit(False)))
    keys = []
    for i, c in enumerate(on):
        mine, theirs = F.col(f"`{c}`"), F.col(f"_on_{i}")
        kind = shown.get(c)
        mine, theirs = (mine, theirs) if kind is None else (mine.cast(kind), theirs.cast(kind))
        keys.append(F.when(F.col("_in_a"), mine).otherwise(theirs).alias(c))
    key_of = dict(zip(on, keys, strict=True))
    return kept.select(*[key_of.get(c, F.col(f"`{c}`")) for c in a.columns], *[F.col(f"`{c}`") for c in b.columns if c not in on])


def _never_equal(df: DataFrame, on: list[str]) -> DataFrame:
    """Rows that miss a part of their key get a key that no row of the other side has: null, which equals nothing."""
    return df.withColumn("_key", F.when(~_any_null(on), F.col("_key")))


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.StringType, T.CharType, T.VarcharType))


def left_on_either(left_df: DataFrame, right_df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``left LEFT JOIN right ON l1 = r1 OR l2 = r2`` as equi-joins.

    Every row stands once for each of its keys, so one inner join on (which key, key) finds all matches; a pair that an earlier
    equality gave already is left out.  The left rows that match none come from an anti join with the right keys.  Same rows,
    multiplicities included; the left is read twice, the right twice, of which once its keys only.  Column names must not clash.
    """
    types = common_types(left_df, right_df, [a for a, _ in pairs], [b for _, b in pairs])
    compared = [t or left_df.schema[a].dataType for t, (a, _) in zip(types, pairs, strict=True)]
    # keys of one type share a column as they are, others as text
    alike = all(t == compared[0] for t in compared)

    def key(column: str, number: int) -> Column:
        value = F.col(f"`{column}`")
        value = value if types[number] is None else value.try_cast(types[number])
        return value if alike else value.cast("string")

    def each_key(df: DataFrame, names: list[str]) -> DataFrame:
        keys = [F.struct(F.lit(i).alias("_which"), key(n, i).alias("_on")) for i, n in enumerate(names)]
        return df.select("*", F.inline(F.array(*keys))).where(F.col("_on").isNotNull())

    lefts, rights = [a for a, _ in pairs], [b for _, b in pairs]
    both = inner(each_key(left_df, lefts), each_key(right_df, rights), ["_which", "_on"])
    earlier = F.lit(False)
    for i, (a, b) in enumerate(pairs[:-1]):
        same = F.coalesce(key(a, i) == key(b, i), F.lit(False))
        earlier = earlier | ((F.col("_which") > i) & same)
    matched = both.where(~earlier).drop("_which", "_on")
    rest = left_df
    for i, name in enumerate(lefts):
        mine = right_df.select(key(rights[i], i).alias("_on")).where(F.col("_on").isNotNull())
        rest = only_in_left(rest.withColumn("_on", key(name, i)), mine, ["_on"]).drop("_on")
    return matched.unionByName(rest, allowMissingColumns=True)


def union_of_matches(left_df: DataFrame, right_df: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """Inner matches by each key in turn, stacked: the key and the carried columns of the left, all columns of the right."""
    parts = [inner(left_df.select(k, *carry), right_df, k).select(*right_df.columns, *carry) for k in keys]
    return reduce(lambda x, y: x.unionByName(y), parts)


def enrich_with_fallback(
    df: DataFrame, lookup: DataFrame, on: str, fills: dict[str, str], when: Column | None = None
) -> DataFrame:
    """Left join a second lookup and fill still-empty columns from it; helper columns are dropped.

    ``fills`` maps a column of ``df`` to the lookup column that backs it.  ``when`` limits the rows that may be filled.
    """
    helper = lookup.select(F.col(on), *[F.col(src).alias(f"_fill_{dst}") for dst, src in fills.items()])
    joined = left_folded(df, helper, on)
    allowed = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    filled = {dst: F.coalesce(F.col(dst), F.when(allowed, F.col(f"_fill_{dst}"))) for dst in fills}
    return joined.withColumns(filled).select(*df.columns)


def lookup_chain(df: DataFrame, steps: list[tuple[DataFrame, Column, str]]) -> DataFrame:
    """A chain of joins given as (frame, condition, kind)."""
    for other, condition, how in steps:
        df = df.join(other, condition, how)
    return df
