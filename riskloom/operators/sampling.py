"""Deterministic sampling, class balancing and the train/test split.

Every selection is driven by a 32-bit md5 hash of the row key, so results are
identical whatever the partitioning, the number of executors or a retried task
(``rand``/``sample(seed)`` depend on the layout).  Rows are ordered by that hash,
then by a 64-bit hash of the whole row; a row without a key takes the hash of
the row for both, so such rows are spread like any others.

"The n smallest rows" is computed without a sort: the order value is read 16
bits at a time, a histogram of each 16 bits (at most 65 536 rows, partial
aggregation) finds the bin of the n-th row, and the next histogram looks into
that bin only.  One or two of them settle unique keys; the cut is then a plain
filter.  Rows that are equal in every column are interchangeable, and only
they can meet at the cut: they are counted, and one of them is repeated.

Rows are repeated in two or more levels (``repeat_rows``), so that neither an
array nor a task grows with the number of copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.stats import hash32

LABEL = "is_fraud"
KEY = "trans_num"
# Fixed values (reference behaviour): 70/30 split.
TRAIN_PCT = 70
SPLIT_SALT = "#split"

#: Elements of an array of copies at most, and copies of a row that are made where it lies.
FAN = 1024
IN_PLACE = 16


def with_hash(df: DataFrame, key: str = KEY, name: str = "_h", salt: str | None = None) -> DataFrame:
    """Add the 32-bit hash of the key; of the whole row where the key is NULL.

    The hash comes out of a one-element generator: conditions on it stay above, so that each
    row is hashed once however often a condition names the hash."""
    row = F.xxhash64(*df.columns).cast("string")
    hashed = hash32(F.coalesce(F.col(key).cast("string"), F.concat(F.lit("row#"), row)), salt)
    return df.select(*[c for c in df.columns if c != name], F.inline(F.array(F.struct(hashed.alias(name)))))


def _digits(h: Column, t: Column) -> list[Column]:
    """The order value (32-bit ``h``, then 64-bit ``t``) in steps of 16 bits."""
    low = F.lit(0xFFFF)
    return [F.shiftright(h, 16), h.bitwiseAND(low)] + [F.shiftrightunsigned(t, k).bitwiseAND(low) for k in (48, 32, 16, 0)]


def flag_smallest(df: DataFrame, n: int, hash_col: str = "_h", flag: str = "_sel", among: Column | None = None) -> DataFrame:
    """Add boolean ``flag``: the row is among the ``n`` smallest (exactly
    ``min(n, rows)`` rows), of those that fulfil ``among`` where it is given (never
    NULL).  See the module docstring."""
    among = F.lit(True) if among is None else among
    tie = F.xxhash64(*[c for c in df.columns if c != hash_col])
    rows = df.withColumn("_t", tie)
    digits = _digits(F.col(hash_col), F.col("_t"))
    equal, below, need = among, F.lit(False), n
    for digit in digits:
        hist = rows.where(equal).groupBy(digit.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("c"))
        run = hist.withColumn("run", F.sum("c").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
        # one row reaches the driver: the first bin by which enough rows are seen
        cut = run.where(F.col("run") >= need).agg(F.min_by(F.struct("bin", "c", "run"), "bin").alias("cut")).first()["cut"]
        if cut is None:  # fewer rows than asked for
            return df.withColumn(flag, among)
        below = below | (equal & (digit < cut["bin"]))
        equal = equal & (digit == cut["bin"])
        need -= cut["run"] - cut["c"]
        if need == cut["c"]:
            return rows.withColumn(flag, below | equal).drop("_t")
    # the cut falls among copies of one row: they are one row and a count, repeated on both sides of the cut
    one = rows.where(equal).agg(F.any_value(F.struct(*df.columns)).alias("_row"))
    sides = F.array(*[F.struct(F.lit(taken).alias(flag), F.lit(n).cast("long").alias("_n")) for taken, n in ((True, need), (False, cut["c"] - need))])
    copies = repeat_rows(one.select("_row.*", F.inline(sides)), F.col("_n"), cut["c"]).drop("_n")
    return rows.where(~equal).withColumn(flag, below).drop("_t").unionByName(copies)


def repeat_rows(df: DataFrame, times: Column, most: int, fan: int = FAN) -> DataFrame:
    """Every row as often as ``times`` says (0 to ``most``).

    A row is cut into blocks of copies, at most ``fan`` of them, the blocks are dealt out
    evenly, and each is cut again until a block is one copy: the levels grow with the logarithm of
    ``most``, no array has more than ``fan`` elements, and the copies of a few rows spread over all
    tasks.  Up to ``IN_PLACE`` copies are made without moving a row."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = 1
    while step * fan < most:
        step *= fan
    rows = df.withColumn("_times", times.cast("long")).where("_times > 0")
    while True:
        if step == 1 and most > IN_PLACE:
            rows = rows.repartition(tasks)
        rows = rows.withColumn("_block", F.explode(F.expr(f"sequence(0L, (_times + {step - 1}) div {step} - 1)")))
        if step == 1:
            return rows.drop("_times", "_block")
        rows = rows.withColumn("_times", F.least(F.lit(step), F.col("_times") - F.col("_block") * step)).drop("_block")
        step //= fan
        if step > 1:
            rows = rows.repartition(tasks)


def smallest_n(df: DataFrame, n: int, key: str = KEY, salt: str | None = None) -> DataFrame:
    """Exactly min(n, rows) rows, the smallest by hash."""
    if n <= 0:
        return df.limit(0)
    return flag_smallest(with_hash(df, key, salt=salt), n).where(F.col("_sel")).drop("_sel", "_h")


def class_filter(df: DataFrame, value: int, label: str = LABEL) -> DataFrame:
    """rows of one class (NULL labels fall out of both classes)."""
    return df.where(F.col(label) == value)


def class_counts(df: DataFrame, label: str = LABEL) -> tuple[int, int]:
    """(positives, negatives): ONE aggregate whose result is two numbers."""
    row = df.agg(
        F.count_if(F.col(label) == 1).alias("n1"),
        F.count_if(F.col(label) == 0).alias("n0"),
    ).first()
    return int(row["n1"]), int(row["n0"])


def undersample(df: DataFrame, label: str = LABEL, key: str = KEY, seed: int | None = None) -> DataFrame:
    """B1 + B6: every minority row plus exactly as many majority rows, the
    smallest by hash (``seed`` draws another order).  Minority = the smaller class
    (label 1 on a tie).  Rows without a 0/1 label are left out; with an empty class
    the other class is returned whole.

    The class sizes are one aggregate (two numbers reach the driver); the
    selection itself stays distributed (``flag_smallest``)."""
    n1, n0 = class_counts(df, label)
    n_min = min(n1, n0)
    labelled = df.where(F.col(label).isin(0, 1))
    if n_min == 0:
        return labelled
    minor = F.col(label) == (1 if n1 <= n0 else 0)
    # one scan for both classes
    flagged = flag_smallest(with_hash(labelled, key, salt=_salt(seed)), n_min, among=~minor)
    return flagged.where(minor | F.col("_sel")).drop("_sel", "_h")


def oversample(df: DataFrame, label: str = LABEL, key: str = KEY, seed: int | None = None) -> DataFrame:
    """B2: exactly 1:1 by repeating minority rows.

    With ``q, r = divmod(n_major, n_minor)`` each minority row appears ``q``
    times, plus once more for the ``r`` smallest by hash -- the same sizes as
    "repeat, union, cut to n_major".  Copies are dealt out in blocks
    (``repeat_rows``): ten positives among 10^9 rows are no task of 10^8
    copies each.  Minority = the smaller class.  Rows without a 0/1 label are left out; with an empty class the
    other class is returned whole."""
    n1, n0 = class_counts(df, label)
    n_min, n_maj = min(n1, n0), max(n1, n0)
    labelled = df.where(F.col(label).isin(0, 1))
    if n_min == 0:
        return labelled
    minority = 1 if n1 <= n0 else 0
    q, r = divmod(n_maj, n_min)
    major = labelled.where(F.col(label) != minority)
    minor = labelled.where(F.col(label) == minority)
    if r:
        flagged = flag_smallest(with_hash(minor, key, salt=_salt(seed)), r).drop("_h")
    else:
        flagged = minor.withColumn("_sel", F.lit(False))
    copies = F.lit(q) + F.when(F.col("_sel"), 1).otherwise(0)
    return major.unionByName(repeat_rows(flagged, copies, q + 1).drop("_sel"))


def _salt(seed: int | None, base: str = "") -> str | None:
    """The hash salt of a seed; none without one."""
    return base or None if seed is None else f"{base}#seed{seed}"


def split(df: DataFrame, train_pct: int = TRAIN_PCT, key: str = KEY, name: str = "split", seed: int | None = None) -> DataFrame:
    """``hash(key) % 100 < train_pct`` -> 'train', else 'test'; ``seed`` draws
    another split.

    Stable when rows are added, independent of partitioning; copies of a row
    always fall on the same side.  Rows without a key are split by their contents."""
    hashed = with_hash(df, key, "_split_hash", _salt(seed, SPLIT_SALT))
    side = F.when(F.col("_split_hash") % 100 < train_pct, F.lit("train")).otherwise(F.lit("test"))
    return hashed.withColumn(name, side).drop("_split_hash")


def train_test(df: DataFrame, train_pct: int = TRAIN_PCT, key: str = KEY, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    s = split(df, train_pct, key, name="_split", seed=seed)
    return s.where(F.col("_split") == "train").drop("_split"), s.where(F.col("_split") == "test").drop("_split")
