"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

1. Components become integers x = floor(64 c) + 1000000.  The fit list is every
   distinct x vector once; tasks add its count n, sums S and products in
   integers, one aggregation adds the tasks (d (d + 1) / 2 numbers).
   M = n sum(x x') - S S' is n^2 times the covariance, exactly.
2. det(t - M): for each of enough 31-bit primes a task reduces M to Hessenberg
   form by elimination modulo the prime and expands the determinant; the Chinese
   remainder theorem gives the integer coefficients.  The primes' product
   exceeds twice (1 + trace / d)^d, which bounds every coefficient, since M has
   no negative root.
3. All roots are real, so the sign changes of the coefficients of p(x + t) count
   the roots above t exactly, with multiplicity.  A task a root bisects on that
   count in integers, to ``BITS`` bits below the root's leading bit.
4. Components: null-space inverse iteration, (M - root) solved in decimals of
   ``DIGITS`` digits by elimination with pivoting.  Roots that agree to ``AGREE`` bits
   share a null space: as many start vectors are iterated and made
   orthonormal together, so equal eigenvalues get an orthonormal basis.
5. Rows are projected in double precision from the exact n x - S; the identity
   error is measured on the whitened fit list.

The driver holds numbers by dimension (never rows): d up to a few hundred.
Components with eigenvalue 0 cannot be scaled to variance 1 and are left out; so
one distinct vector gives no rows, as does an empty table.  Rows with a null
vector, an empty one, null or non-finite entries, or an entry whose x exceeds
2^40 in size take no part; vectors of other lengths than the commonest (ties: the
shorter) neither.  Repeated rows are one in the fit, each in the result; a null
vec_id keeps its row.  ``deviation`` is null if beyond 64 bits.  Only vec_id and
embedding are read, so other columns cannot clash.
"""

from __future__ import annotations

import decimal
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import saved

SCALE, SHIFT = 64, 1_000_000
#: Bits of a root below its leading bit; roots that agree so far share a null space; decimals of the solves.
BITS, AGREE, DIGITS = 260, 200, 120
#: Entries are added in three base-2**21 digits: exact in doubles over a batch of rows.
DIGIT, ROWS = 21, 2048
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
OUT_ARROW = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the usable rows of the commonest length."""
    v = F.col(vector_col).cast("array<double>")
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < float(1 << 40)))
    out = out.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fine)
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    out = out.select("vec_id", x.alias("x"))
    common = out.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "d").first()
    return out.filter(F.size("x") == (common["d"] if common else 0))


def matrix(column) -> np.ndarray:
    """The rows of an Arrow list column as an integer matrix."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(a), -1)


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x in Python integers: base-2**21 digits multiply exactly in doubles."""
    d = x.shape[1]
    total = np.zeros((d, d), object)
    for lo in range(0, len(x), ROWS):
        part = x[lo : lo + ROWS]
        low, rest = part & ((1 << DIGIT) - 1), part >> DIGIT
        digits = [low.astype(float), rest.astype(float)] if rest.any() else [low.astype(float)]
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                total += (a.T @ b).astype(np.int64).astype(object) * (1 << DIGIT * (i + j))
    return total


def scatter(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, M) of the fit list, exact: tasks add theirs, an aggregation adds the tasks."""

    def sums(batches):
        n, s, p = 0, 0, 0
        for b in batches:
            if len(b):
                x = matrix(b.column(0)) - SHIFT  # small numbers; shifted back below
                n, s, p = n + len(x), s + x.sum(0).astype(object), p + exact_products(x)
        if n:
            d = len(s)
            i, j = np.triu_indices(d)
            cells = [(-1, -1, n), *((-1, k, s[k]) for k in range(d)), *zip(i.tolist(), j.tolist(), p[i, j], strict=True)]
            a, b, c = zip(*cells, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array([str(v) for v in c])], names=["i", "j", "v"])

    told = fit.select("x").mapInArrow(sums, "i int, j int, v string")
    told = told.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()  # by dimension, not by rows
    if not told:
        return 0, [], []
    cell = {(r["i"], r["j"]): int(r["v"]) for r in told}
    n, d = cell[-1, -1], max(j for _, j in cell) + 1
    s = [cell[-1, k] for k in range(d)]
    m = [[n * cell[min(i, j), max(i, j)] - s[i] * s[j] for j in range(d)] for i in range(d)]
    return n, [v + n * SHIFT for v in s], m


# --- characteristic polynomial ----------------------------------------------


def primes(above: int, most: int = (1 << 31) - 1) -> list[int]:
    """Primes from ``most`` down whose product exceeds ``above`` (strong-probable tests to four bases are exact below 2**32)."""

    def prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            v = pow(base, odd, p)
            if v not in (1, p - 1) and all((v := v * v % p) != p - 1 for _ in range(twos - 1)):
                return False
        return True

    out, product, p = [], 1, most
    while product <= above:
        if prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_modulo(m: np.ndarray, p: int) -> list[int]:
    """Coefficients (constant first) of det(t - m) modulo a prime below 2**31: Hessenberg form, then its recurrence."""
    h, d = m.astype(np.int64) % p, len(m)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        r = k + 1 + int(below[0])
        if r != k + 1:  # the same exchange of rows and columns keeps the polynomial
            h[[k + 1, r]] = h[[r, k + 1]]
            h[:, [k + 1, r]] = h[:, [r, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1][None, :] % p) % p
        for row, f in enumerate(factor.tolist(), k + 2):
            h[:, k + 1] = (h[:, k + 1] + f * h[:, row] % p) % p
    leading = [np.array([1], np.int64)]  # det(t - leading block) of sizes 0, 1, ...
    for k in range(d):
        poly = np.zeros(k + 2, np.int64)
        poly[1:] = leading[k]
        poly[: k + 1] = (poly[: k + 1] - int(h[k, k]) * leading[k] % p) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            poly[: i + 1] = (poly[: i + 1] - int(h[i, k]) * chain % p * leading[i] % p) % p
        leading.append(poly % p)
    return leading[d].tolist()


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Integer coefficients (constant first) of det(t - M): a task a prime, then Chinese remaindering."""
    d, trace = len(m), sum(m[i][i] for i in range(len(m)))
    bound = (1 + trace // d + 1) ** d
    used = primes(2 * bound + 1)
    shared = spark.sparkContext.broadcast(m)

    def reduce(batches):
        for b in batches:
            for p in b.column(0).to_pylist():
                residues = np.array([[v % p for v in row] for row in shared.value], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([polynomial_modulo(residues, p)], pa.list_(pa.int64()))], names=["p", "c"])

    at = spark.createDataFrame([(p,) for p in used], "p long").repartition(min(len(used), 64))
    told = {r["p"]: r["c"] for r in at.mapInArrow(reduce, "p long, c array<long>").collect()}
    product = math.prod(used)
    weight = [product // p * pow(product // p, -1, p) for p in used]
    out = []
    for k in range(d + 1):
        c = sum(w * told[p][k] for w, p in zip(weight, used, strict=True)) % product
        out.append(c - product if 2 * c > product else c)
    return out


# --- roots and components ------------------------------------------------------


def roots_above(poly: list[int], at: int, shift: int) -> int:
    """How many roots exceed at / 2**shift, with multiplicity (all roots real: the sign changes of p(x + t) count them)."""
    d = len(poly) - 1
    c = [v << shift * (d - k) for k, v in enumerate(poly)]  # 2**(shift d) p(x / 2**shift)
    for i in range(d):  # Taylor shift by Horner's scheme
        for k in range(d - 1, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def nth_root(poly: list[int], nth: int) -> tuple[int, int]:
    """(a, shift) with the nth largest root (from 1) in (a / 2**shift, (a + 1) / 2**shift]; a = -1: the root is 0.

    All roots are 0 or more.  Plain halving finds the leading bit, then the bits below it.
    """
    if roots_above(poly, 0, 0) < nth:
        return -1, 0
    high = 1
    while roots_above(poly, high, 0) >= nth:
        high *= 2
    low = high // 2  # whole part: root in (low, high], or (0, 1]
    shift = 0
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if roots_above(poly, mid, 0) >= nth else (low, mid)
    if low == 0:  # a root of at most 1: its leading bit lies below the point
        while roots_above(poly, 1, shift + 1) < nth:
            shift += 1
        low, shift = 1, shift + 1
    while low.bit_length() < BITS:
        low, shift = 2 * low, shift + 1
        low += roots_above(poly, low + 1, shift) >= nth
    return low, shift


def null_space(m: list[list[int]], root: Decimal, size: int) -> list[list[Decimal]]:
    """``size`` orthonormal vectors of the null space of M - root, by inverse iteration (one elimination, three turns)."""
    d = len(m)
    a = np.array([[Decimal(v) for v in row] for row in m], object)
    a[np.arange(d), np.arange(d)] -= root
    tiny = max(abs(v) for v in a.ravel()) * Decimal(10) ** (8 - DIGITS) or Decimal(1)
    order = list(range(d))
    for k in range(d):
        r = max(range(k, d), key=lambda i: abs(a[i, k]))
        if r != k:
            a[[k, r]] = a[[r, k]]
            order[k], order[r] = order[r], order[k]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        if k + 1 < d:
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= a[k + 1 :, k][:, None] * a[k, k + 1 :][None, :]
    rng = np.random.default_rng(5)
    found = [np.array([Decimal(int(v)) for v in rng.integers(-1000, 1000, d)], object) for _ in range(size)]
    for _ in range(3):
        solved = []
        for x in found:
            x = x[order]
            for k in range(1, d):
                x[k] -= (a[k, :k] * x[:k]).sum()
            for k in range(d - 1, -1, -1):
                rest = (a[k, k + 1 :] * x[k + 1 :]).sum() if k + 1 < d else Decimal(0)
                x[k] = (x[k] - rest) / a[k, k]
            for y in (*solved, *solved):  # twice: orthogonal to the last digits
                x = x - y * (x * y).sum()
            solved.append(x / (x * x).sum().sqrt())
        found = solved
    return [v.tolist() for v in found]


def components(spark: SparkSession, m: list[list[int]], most: int = 16) -> list[tuple[Decimal, list[Decimal]]]:
    """(eigenvalue of M, unit eigenvector) of the ``most`` largest non-zero eigenvalues, falling."""
    poly = characteristic_polynomial(spark, m)
    shared = spark.sparkContext.broadcast((poly, m))
    wanted = min(most, len(m))

    def roots(batches):
        for b in batches:
            for nth in b.column(0).to_pylist():
                a, shift = nth_root(shared.value[0], nth)
                yield pa.RecordBatch.from_arrays([pa.array([nth], pa.int64()), pa.array([str(a)]), pa.array([shift], pa.int64())], names=["nth", "a", "shift"])

    # one more root than wanted: the last may share its null space with it
    at = spark.range(1, min(wanted + 1, len(m)) + 1, 1, wanted + 1)
    told = sorted((r["nth"], int(r["a"]), r["shift"]) for r in at.mapInArrow(roots, "nth long, a string, shift long").collect())
    found = [(a, shift) for _, a, shift in told if a > 0]
    groups: list[list[tuple[int, int]]] = []
    for a, shift in found:
        if groups:
            b, other = groups[-1][0]
            far = abs((a << other) - (b << shift)) << AGREE
            if far <= (b << shift):
                groups[-1].append((a, shift))
                continue
        groups.append([(a, shift)])

    def vectors(batches):
        for b in batches:
            for number, a, shift, size in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                with decimal.localcontext() as context:
                    context.prec = DIGITS
                    root = (Decimal(int(a)) + Decimal("0.5")) / (1 << shift)
                    for v in null_space(shared.value[1], root, size):
                        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([str(root)]), pa.array([[str(c) for c in v]])], names=["number", "root", "v"])

    if not groups:
        return []
    rows = [(i, str(g[0][0]), g[0][1], len(g)) for i, g in enumerate(groups)]
    asked = spark.createDataFrame(rows, "number long, a string, shift long, size int").repartition(len(rows))
    told = asked.mapInArrow(vectors, "number long, root string, v array<string>").collect()
    out = [(r["number"], Decimal(r["root"]), [Decimal(c) for c in r["v"]]) for r in told]
    return [(root, v) for _, root, v in sorted(out, key=lambda x: x[0])][:wanted]


# --- the rows ---------------------------------------------------------------


def whiten(rows: DataFrame, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    usable = saved(integer_vectors(rows, id_col, vector_col), "whiten-rows")
    fit = saved(usable.select("x").distinct(), "whiten-fit")
    n, s, m = scatter(fit)
    found = components(spark, m, most) if n > 1 else []
    if not found:
        return spark.createDataFrame([], OUT)
    with decimal.localcontext() as context:
        context.prec = DIGITS
        trace = Decimal(sum(m[i][i] for i in range(len(m))))
        explained = np.array([float(e / trace) for e, _ in found])
        # (n x - S) / n projected, over sqrt(e / n^2): the n cancels
        axes = np.array([[float(c / e.sqrt()) for c in v] for e, v in found]).T
    model = spark.sparkContext.broadcast((n, s, axes, explained))

    def centred(x: np.ndarray) -> np.ndarray:
        """n x - S: in 64 bits where it fits, else in Python integers."""
        n, s, _, _ = model.value
        if n * (int(np.abs(x).max(initial=0)) + max(abs(v) // n + 1 for v in s)) < 1 << 62:
            return n * x - np.array(s, np.int64)
        return n * x.astype(object) - np.array(s, object)

    def deviation(z: np.ndarray) -> list:
        """The exact sums of squares; null beyond 64 bits."""
        small = (z.astype(float) ** 2).sum(1) < 9e18
        out = (z * z).sum(1).tolist() if small.all() and z.dtype != object else [sum(v * v for v in row) for row in z.tolist()]
        return [v if v < 1 << 63 else None for v in out]

    def moments(batches):
        total = 0
        for b in batches:
            if len(b):
                w = centred(matrix(b.column(0))).astype(float) @ model.value[2]
                total = total + np.concatenate([w.sum(0), (w.T @ w).ravel()])
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    told = fit.select("x").mapInArrow(moments, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    total, k = np.array([r["v"] for r in told]), len(found)
    mean = total[:k] / n
    error = float(np.abs(total[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())

    def project(batches):
        for b in batches:
            ids, x = b.column(0), matrix(b.column(1))
            z = centred(x)
            which = pa.array(np.repeat(np.arange(len(b)), k))
            cols = [ids.take(which), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(b))), pa.array(np.full(k * len(b), n)),
                    pa.array(deviation(z), pa.int64()).take(which), pa.array((z.astype(float) @ model.value[2]).ravel()), pa.array(np.tile(model.value[3], len(b))), pa.array(np.full(k * len(b), error))]
            yield pa.RecordBatch.from_arrays(cols, schema=OUT_ARROW)

    return usable.select("vec_id", "x").mapInArrow(project, OUT)
