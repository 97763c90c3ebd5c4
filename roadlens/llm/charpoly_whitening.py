"""Embedding whitening by the exact characteristic polynomial (operator 11).

Every entry c becomes the whole number floor(1024 c) + 100000. The scatter
M = n * sum(x x') - S S' (n squared times the covariance) is a matrix of whole
numbers and is found exactly: tasks add products of 20-bit digits, Spark adds
their sums. Everything after that depends on the dimension d alone:

1. the characteristic polynomial of M modulo primes below 2^31, by Hessenberg
   reduction, one prime a row of a Spark table; Chinese remaindering, one
   coefficient a group. Maclaurin's inequality bounds the coefficients.
2. its largest roots: repeated roots are split off by the modular gcd with the
   derivative; as all roots are real, the sign changes of the shifted polynomial
   count the roots above a point exactly (Budan), so bisection isolates them;
   then signs narrow each to 2^-80 of its distance to the next root.
3. eigenvectors by inverse iteration on M - root in decimals with as many
   digits as the gap asks for; a root of multiplicity m has m of them.

The rows are then projected. Vectors go neither to the driver nor through a
shuffle; the driver holds d x d numbers.

Defined cases: vectors that are null, empty, hold null or non-finite entries,
or have another length than most (ties: the shorter) are dropped; entries
beyond the long range saturate; components with eigenvalue zero can not be
whitened and have no rows (one row, or equal rows: an empty result); rows with a
null id stay; repeated rows each count; a deviation beyond 38 digits is null.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import written

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
DIGIT = 20
CHUNK = 2048
GUARD = 80
#: Whole numbers kept in 64 bits stay below this.
WIDE = 2**62


def complete(vector: str) -> Column:
    """Whether the vector has entries, all of them finite numbers."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def remaining(vectors: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows that take part, and their dimension (0: none)."""
    rows = vectors.where(complete(vector))
    width = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = width["d"] if width else 0
    return rows.where(F.size(vector) == d), d


def whole_numbers(column: pa.Array, d: int) -> np.ndarray:
    """(rows x d) floor(SCALE c); the shift of x cancels in every centred figure and is left out."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * c)
    limit = float(2**63 - 2**20)
    return np.clip(scaled, -limit, limit).astype(np.int64)


# -- exact scatter ------------------------------------------------------------


def digits(y: np.ndarray) -> list[np.ndarray]:
    """``y`` in signed digits of 20 bits, lowest first, as doubles."""
    out = []
    while y.size and max(-int(y.min()), int(y.max())) >= 1 << DIGIT:
        low = (y & ((1 << DIGIT) - 1)) - ((y & (1 << (DIGIT - 1))) << 1)
        out.append(low.astype(np.float64))
        y = (y >> DIGIT) + ((y >> (DIGIT - 1)) & 1)
    return [*out, y.astype(np.float64)]


def partial_sums(vector: str, d: int):
    """A task's count, sums and products as rows (i, j, shift, value): value * 2^shift; j = -1: a sum, i = -1: the count."""
    upper = np.triu_indices(d)

    def entries(n: int, sums: dict, products: dict) -> Iterator[pa.RecordBatch]:
        parts = [(np.array([-1]), np.array([-1]), 0, np.array([n], np.int64))]
        parts += [(np.arange(d), np.full(d, -1), shift, v) for shift, v in sums.items()]
        parts += [(*upper, shift, v[upper]) for shift, v in products.items()]
        for i, j, shift, v in parts:
            for at, part in ((shift, v & (2**31 - 1)), (shift + 31, v >> 31)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(len(part), at), pa.int32()), pa.array(part)], names=["i", "j", "shift", "value"]
                )

    def run(batches):
        n, sums, products = 0, {}, {}
        for batch in batches:
            y = whole_numbers(batch.column(vector), d)
            for lo in range(0, len(y), CHUNK):
                parts = digits(y[lo : lo + CHUNK])
                n += len(parts[0])
                for a, left in enumerate(parts):
                    sums[DIGIT * a] = sums.get(DIGIT * a, 0) + left.sum(axis=0).astype(np.int64)
                    for b, right in enumerate(parts):
                        at = DIGIT * (a + b)
                        products[at] = products.get(at, 0) + (left.T @ right).astype(np.int64)
                if n >= CHUNK * 128:  # 128 chunks of at most 16 products below 2^51 fit 64 bits
                    yield from entries(n, sums, products)
                    n, sums, products = 0, {}, {}
        if n:
            yield from entries(n, sums, products)

    return run


def scatter(rows: DataFrame, vector: str, d: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums, and M = n * sum(y y') - T T' as Python whole numbers."""
    total = rows.select(vector).mapInArrow(partial_sums(vector, d), "i int, j int, shift int, value long").groupBy("i", "j", "shift").agg(F.sum("value").alias("value"))
    n, sums, products = 0, [0] * d, np.zeros((d, d), object)
    for r in total.collect():  # d^2 rows a digit pair, whatever the row count
        v = r["value"] << r["shift"]
        if r["i"] < 0:
            n += v
        elif r["j"] < 0:
            sums[r["i"]] += v
        else:
            products[r["i"], r["j"]] += v
    products += np.triu(products, 1).T
    t = np.array(sums, object)
    return n, sums, n * products - np.outer(t, t)


# -- characteristic polynomial ------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller-Rabin; the bases decide every n below 3,215,031,751."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes() -> Iterator[int]:
    """Primes below 2^31, largest first."""
    return (n for n in range(2**31 - 1, 2**30, -2) if is_prime(n))


def charpoly_modulo(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - m) modulo ``p``, constant term first; ``m`` holds residues."""
    h, d = m.astype(np.int64), len(m)
    for k in range(d - 2):
        nonzero = np.flatnonzero(h[k + 1 :, k])
        if not len(nonzero):
            continue
        i = k + 1 + nonzero[0]
        h[[i, k + 1]] = h[[k + 1, i]]
        h[:, [i, k + 1]] = h[:, [k + 1, i]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        new = np.roll(polys[k - 1], 1) - h[k - 1, k - 1] * polys[k - 1] % p
        below = 1
        for i in range(k - 1, 0, -1):
            below = below * int(h[i, i - 1]) % p
            if not below:
                break
            new = (new - int(h[i - 1, k - 1]) * below % p * polys[i - 1] % p) % p
        polys[k] = new % p
    return polys[d]


def remaindered(residues: list[int], moduli: list[int]) -> int:
    """The whole number of least size with these residues."""
    x, product = 0, 1
    for r, p in zip(residues, moduli):
        x += product * ((r - x) * pow(product, -1, p) % p)
        product *= p
    return x - product if 2 * x > product else x


def characteristic_polynomial(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Coefficients of det(x - m) for a positive semidefinite matrix of whole numbers, constant term first."""
    d, trace = len(m), int(np.trace(m))
    bound = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    chosen, product = [], 1
    for p in primes():
        if product > 2 * bound:
            break
        chosen.append(p)
        product *= p
    shared = spark.sparkContext.broadcast(m)  # d x d numbers

    def residues(batches):
        for batch in batches:
            for p in batch.column("p").to_pylist():
                coefficients = charpoly_modulo((shared.value % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(d + 1), pa.int32()), pa.array(np.full(d + 1, p)), pa.array(coefficients)], names=["k", "p", "residue"]
                )

    def lifted(group: pa.Table) -> pa.Table:
        x = remaindered(group.column("residue").to_pylist(), group.column("p").to_pylist())
        return pa.table({"k": group.column("k")[:1], "value": [str(x)]})

    table = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(max(1, min(len(chosen), spark.sparkContext.defaultParallelism)))
    rows = table.mapInArrow(residues, "k int, p long, residue long").groupBy("k").applyInArrow(lifted, "k int, value string").collect()
    return [int(r["value"]) for r in sorted(rows, key=lambda r: r["k"])]


# -- roots --------------------------------------------------------------------


def trimmed(a: list[int]) -> list[int]:
    while a and a[-1] == 0:
        a = a[:-1]
    return a


def gcd_modulo(a: list[int], b: list[int], p: int) -> list[int]:
    """The monic greatest common divisor modulo ``p``."""
    a, b = trimmed([x % p for x in a]), trimmed([x % p for x in b])
    while b:
        inverse = pow(b[-1], -1, p)
        b = [x * inverse % p for x in b]
        while len(a) >= len(b):
            q, at = a[-1], len(a) - len(b)
            a = trimmed(a[:at] + [(x - q * y) % p for x, y in zip(a[at:], b)])
        a, b = b, a
    return a


def divided(a: list[int], b: list[int]) -> list[int] | None:
    """``a`` / ``b`` for a monic ``b``; None if it does not divide."""
    a, out = list(a), []
    while len(a) >= len(b):
        q, at = a[-1], len(a) - len(b)
        out.append(q)
        for i, y in enumerate(b):
            a[at + i] -= q * y
        a.pop()
    return None if any(a) else out[::-1]


def square_free(c: list[int]) -> list[int]:
    """The monic polynomial with the roots of the monic ``c``, each once."""
    slope = [k * x for k, x in enumerate(c)][1:]
    images: dict[int, list[int]] = {}
    last: list[int] | None = None
    for p in primes():
        g = gcd_modulo(c, slope, p)
        if len(g) == 1:
            return c
        least = min([len(g), *map(len, images.values())])
        images = {q: x for q, x in {**images, p: g}.items() if len(x) == least}
        lifted = [remaindered([x[k] for x in images.values()], list(images)) for k in range(least)]
        if lifted == last and divided(slope, lifted) is not None and (quotient := divided(c, lifted)) is not None:
            return quotient
        last = lifted
    raise ArithmeticError("no greatest common divisor found")


def roots_above(c: list[int], a: int, s: int) -> int:
    """How many roots (with multiplicity) of a polynomial with real roots only lie above a / 2^s."""
    deg = len(c) - 1
    b = [x << (s * (deg - k)) for k, x in enumerate(c)]
    for low in range(deg):
        for k in range(deg - 1, low - 1, -1):
            b[k] += a * b[k + 1]
    signs = [x > 0 for x in b if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(c: list[int], a: int, s: int) -> int:
    value = 0
    for k, x in enumerate(reversed(c)):
        value = value * a + (x << (s * k))
    return (value > 0) - (value < 0)


def largest_roots(c: list[int], wanted: int) -> list[tuple[int, int, int, int]]:
    """(a, s, multiplicity, spread) by falling root a / 2^s, until ``wanted`` roots are counted.

    The error of a root is below 2^-GUARD of the root and of its distance to
    every other root; ``spread`` is the decimal digits from that error up to the trace.
    """
    zeros = next(k for k, x in enumerate(c) if x)
    c = c[zeros:]
    if len(c) == 1:
        return []
    free = square_free(c)
    top = max(1, -c[-2]).bit_length()  # the sum of the roots lies below 2^top

    # open intervals (lo, hi] at scale s, highest first, with their counts of different roots
    alone, counted = [], 0
    memo: dict[tuple[int, int], int] = {}

    def above(a: int, s: int) -> int:
        while s and a % 2 == 0:
            a, s = a // 2, s - 1
        if (a, s) not in memo:
            memo[a, s] = roots_above(free, a, s)
        return memo[a, s]

    stack = [(0, 1 << top, 0, len(free) - 1)]
    while stack:
        lo, hi, s, n = stack.pop()
        if n == 0:
            continue
        if n == 1:
            multiplicity = roots_above(c, lo, s) - roots_above(c, hi, s)
            alone.append((lo, hi, s, multiplicity))
            counted += multiplicity
            if counted - multiplicity >= wanted:
                break  # one root more than wanted, for the last gap
            continue
        mid = lo + hi
        high = above(mid, s + 1) - above(hi, s)
        stack += [(2 * lo, mid, s + 1, n - high), (mid, 2 * hi, s + 1, high)]

    def narrowed(lo: int, hi: int, s: int) -> tuple[int, int, int]:
        mid = lo + hi
        lo, hi, s = 2 * lo, 2 * hi, s + 1
        at, end = sign_at(free, mid, s), sign_at(free, hi, s)
        if at == 0 or end == 0:
            return (mid, mid, s) if at == 0 else (hi, hi, s)
        return (lo, mid, s) if at == end else (mid, hi, s)

    def apart(x, y) -> bool:
        """Whether both intervals are shorter than a quarter of the gap between them."""
        s = max(x[2], y[2])
        (xl, xh), (yl, yh) = ((v[0] << (s - v[2]), v[1] << (s - v[2])) for v in (x, y))
        return 4 * max(xh - xl, yh - yl) < max(xl - yh, yl - xh)

    spans = [x[:3] for x in alone]
    for i in range(len(spans) - 1):
        while not apart(spans[i], spans[i + 1]):
            spans[i], spans[i + 1] = (x if x[0] == x[1] else narrowed(*x) for x in (spans[i], spans[i + 1]))
    out, counted = [], 0
    for i, span in enumerate(spans):
        if counted >= wanted:
            break
        others = [spans[j] for j in (i - 1, i + 1) if 0 <= j < len(spans)]
        near = [abs(decimal_of(x[0], x[2]) - decimal_of(span[0], span[2])) / 2 for x in others]
        limit = min([decimal_of(max(span[0], 1), span[2]), *near]) / 2**GUARD
        while span[0] != span[1] and decimal_of(span[1] - span[0], span[2]) > limit:
            span = narrowed(*span)
        spread = decimal_of(1 << top, 0).adjusted() - limit.adjusted() + 1
        out.append((span[0] + span[1], span[2] + 1, alone[i][3], spread))
        counted += alone[i][3]
    return out


def decimal_of(a: int, s: int) -> decimal.Decimal:
    """a / 2^s with as many digits as it takes."""
    with decimal.localcontext(decimal.Context(prec=max(28, a.bit_length() + s + 8), Emin=-(10**9), Emax=10**9)):
        return decimal.Decimal(a) / (decimal.Decimal(2) ** s)


# -- eigenvectors ---------------------------------------------------------------


def null_space(m: np.ndarray, a: int, s: int, multiplicity: int, spread: int) -> np.ndarray:
    """(multiplicity x d) orthonormal eigenvectors to the root near a / 2^s, by inverse iteration."""
    d = len(m)
    context = decimal.Context(prec=40 + 2 * spread, Emin=-(10**9), Emax=10**9)
    with decimal.localcontext(context):
        number = np.frompyfunc(decimal.Decimal, 1, 1)
        lu = number(m)
        lu[np.arange(d), np.arange(d)] -= decimal.Decimal(a) / decimal.Decimal(2) ** s
        tiny = decimal.Decimal(1).scaleb(-(context.prec // 2))
        order = np.arange(d)
        for k in range(d):
            best = k + max(range(d - k), key=lambda i: abs(lu[k + i, k]))
            lu[[k, best]], order[[k, best]] = lu[[best, k]], order[[best, k]]
            if not lu[k, k]:
                lu[k, k] = tiny
            lu[k + 1 :, k] /= lu[k, k]
            lu[k + 1 :, k + 1 :] -= np.outer(lu[k + 1 :, k], lu[k, k + 1 :])
        start = np.random.default_rng(11).integers(-999, 1000, (multiplicity, d))
        basis = number(start.astype(object))
        for _ in range(3):
            done: list[np.ndarray] = []
            for v in basis:
                x = v[order]
                for k in range(d):
                    x[k + 1 :] -= lu[k + 1 :, k] * x[k]
                for k in range(d - 1, -1, -1):
                    x[k] /= lu[k, k]
                    x[:k] -= lu[:k, k] * x[k]
                x /= max(abs(t) for t in x)
                for _ in range(2):
                    for u in done:
                        x = x - u * (u * x).sum()
                done.append(x / (x * x).sum().sqrt())
            basis = np.array(done, object)
        out = basis.astype(np.float64)
    first = np.abs(out).argmax(axis=1)
    return out * np.sign(out[np.arange(len(out)), first])[:, None]


def principal_components(spark: SparkSession, m: np.ndarray, wanted: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Roots as (a, s) for a / 2^s with eigenvectors as rows, by falling root, repeated by multiplicity."""
    found = largest_roots(characteristic_polynomial(spark, m), wanted)
    if not found:
        return [], np.zeros((0, len(m)))
    shared = spark.sparkContext.broadcast(m)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                vectors = null_space(shared.value, int(r["a"]), r["s"], r["multiplicity"], r["spread"])
                yield pa.RecordBatch.from_arrays([pa.array([r["nth"]], pa.int32()), pa.array([vectors.ravel().tolist()])], names=["nth", "vectors"])

    rows = [(i, str(a), s, mult, spread) for i, (a, s, mult, spread) in enumerate(found)]
    table = spark.createDataFrame(rows, "nth int, a string, s int, multiplicity int, spread int").repartition(len(rows))
    got = sorted(table.mapInArrow(run, "nth int, vectors array<double>").collect(), key=lambda r: r["nth"])
    vectors = np.concatenate([np.array(r["vectors"]).reshape(-1, len(m)) for r in got])[:wanted]
    return [(a, s) for a, s, mult, _ in found for _ in range(mult)][:wanted], vectors


# -- whitening --------------------------------------------------------------------


def projected(vector: str, d: int, n: int, sums: list[int], basis: np.ndarray):
    """deviation and whitened of every row; ``basis``: (components x d), over the roots of the eigenvalues."""
    centre = np.array(sums, object)
    room = max(map(abs, sums))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            y = whole_numbers(batch.column(vector), d)
            largest = n * max(-int(y.min()), int(y.max())) + room
            if largest * largest * d < WIDE:
                from_mean = n * y - centre.astype(np.int64)
                deviation = pa.array((from_mean * from_mean).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                from_mean = n * y.astype(object) - centre
                exact = (from_mean * from_mean).sum(axis=1)
                deviation = pa.array([decimal.Decimal(int(v)) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
            white = (from_mean / n).astype(np.float64) @ basis.T
            ends = pa.array(np.arange(0, white.size + 1, len(basis)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), deviation, pa.ListArray.from_arrays(ends, pa.array(white.ravel()))], names=["vec_id", "deviation", "whitened"]
            )

    return run


def identity_error(rows: DataFrame, k: int) -> float:
    """Largest entry, by size, of the covariance of ``whitened`` minus the identity."""
    at = [F.element_at("whitened", i + 1) for i in range(k)]
    means = rows.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(at)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = rows.agg(*[F.avg((at[i] - means[i]) * (at[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(cov, pairs))


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error: a row per vector and component."""
    spark = vectors.sparkSession
    kept, d = remaining(vectors.select(F.col(id_column).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")), "vector")
    n, sums, m = scatter(kept, "vector", d) if d else (0, [], np.zeros((0, 0), object))
    roots, basis = principal_components(spark, m, components) if n and np.trace(m) else ([], None)
    id_type = kept.schema["vec_id"].dataType.simpleString()
    if not roots:
        return spark.createDataFrame([], f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    values = [decimal_of(a, s) for a, s in roots]
    spread = np.array([math.sqrt(v / (n * n)) for v in values])
    run = projected("vector", d, n, sums, basis / spread[:, None])
    rows = written(kept.mapInArrow(run, f"vec_id {id_type}, deviation decimal(38,0), whitened array<double>"), "whitened")
    trace = decimal.Decimal(int(np.trace(m)))
    explained = F.array(*[F.lit(float(v / trace)) for v in values])
    error = identity_error(rows, len(values))
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
