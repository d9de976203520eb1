"""Document fingerprints by winnowing, in DataFrame and SQL functions only.

A text's units are its runs of characters that are no white space, cut into pieces of at most PIECE
characters, so that texts without spaces have units too. Each K consecutive units have a rolling hash (the
units' hashes, rotated by their place and combined by exclusive or). Of each WINDOW consecutive hashes the
least is chosen, the rightmost of equal ones; the fingerprint is every chosen hash with its position. Two
texts that share K + WINDOW - 1 consecutive units share a fingerprint hash, and the positions say where.

Fewer than K units have one hash of them all; fewer than WINDOW hashes are one window. Null and empty texts
have an empty fingerprint. Likeness is the Jaccard index of the chosen hashes; two empty ones are alike (1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 3
WINDOW = 4
PIECE = 8
BUCKET_MB = 16
MAX_RANGES = 4096  # their edges are literals of the plan; larger ranges sort with spilling


def with_fingerprint(df: DataFrame, text_col: str, name: str, k: int = K, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """df with ``name``_hash (all rolling hashes) and ``name``_at (chosen positions, from 0).

    Every step is a column of its own that the next one names several times: so it is computed once a row.
    """
    g, h, m, at = f"{name}_unit", f"{name}_hash", f"{name}_least", f"{name}_at"
    turned = " ^ ".join(f"(shiftleft({x}, {r}) | shiftrightunsigned({x}, {64 - r}))" if (r := k - 1 - i) else x
                        for i, x in enumerate(["x", *(f"get({g}, i + {i})" for i in range(1, k))]))
    least = ", ".join(["x", *(f"get({h}, i + {i})" for i in range(1, window))])
    right = " ".join(f"when get({h}, i + {i}) = x then i + {i}" for i in range(window - 1, 0, -1))
    return (
        df.withColumn(g, F.expr(f"transform(regexp_extract_all(coalesce({text_col}, ''), '[^ \\\\t-\\\\r]{{1,{piece}}}', 0), x -> xxhash64(x))"))
        .withColumn(h, F.expr(f"""case when size({g}) >= {k} then filter(transform({g}, (x, i) -> if(i <= size({g}) - {k}, {turned}, null)), x -> x is not null)
                                  when size({g}) > 0 then array(xxhash64({g})) else cast(array() as array<bigint>) end"""))
        .withColumn(m, F.expr(f"""case when size({h}) >= {window} then filter(transform({h}, (x, i) -> if(i <= size({h}) - {window}, least({least}), null)), x -> x is not null)
                                  else cast(array() as array<bigint>) end"""))
        .withColumn(at, F.expr(f"""case when size({m}) > 0 then array_distinct(transform({m}, (x, i) -> case {right} else i end))
                                   when size({h}) > 0 then array(size({h}) - cast(array_position(reverse({h}), array_min({h})) as int))
                                   else cast(array() as array<int>) end"""))
        .drop(g, m)
    )


def chosen(name: str) -> Column:
    return F.expr(f"array_distinct(transform({name}_at, p -> get({name}_hash, p)))")


def written(name: str) -> Column:
    """hash:position of each chosen hash, by position, joined by spaces."""
    return F.expr(f"array_join(transform({name}_at, p -> concat(lower(hex(get({name}_hash, p))), ':', p)), ' ')")


def likeness(a: str, b: str) -> Column:
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def with_next(df: DataFrame, id_col: str, text_col: str, bucket_mb: int = BUCKET_MB) -> DataFrame:
    """df with next_text: the text of the next row by descending id (null ids last, then by text); after the
    last comes the first. Ranges of ids of about bucket_mb are windows of their own; the row that ends
    the range below is copied to each, so the texts are shuffled once and no task orders the whole table."""
    n_bytes = df.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 64)).first()[0] or 0
    n = min(MAX_RANGES, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // (bucket_mb << 20))))
    top, cuts = df.agg(F.max(id_col), F.percentile_approx(id_col, [i / n for i in range(1, n)] or [0.5], 100 * n)).first()
    edges = sorted({*(cuts or []), *([top] if top is not None else [])})
    # two levels of comparisons, so that a row costs about twice the root of the number of ranges
    step = max(1, int(len(edges) ** 0.5))
    groups = [edges[i : i + step] for i in range(0, len(edges), step)]
    longs = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<bigint>") if xs else F.expr("cast(array() as array<bigint>)")
    coarse = F.size(F.filter(longs([g[-1] for g in groups]), lambda e: e < F.col(id_col)))
    fine = F.get(F.array(*[longs(g) for g in groups]) if groups else F.array(longs([])), coarse)
    bucket = F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(coarse * step + F.size(F.filter(fine, lambda e: e < F.col(id_col))))
    is_edge = F.size(F.filter(F.coalesce(F.get(F.array(*[longs(g) for g in groups]) if groups else F.array(longs([])), F.col("_coarse")), longs([])), lambda e: e == F.col(id_col))) > 0
    place = lambda b, late, own: F.struct(b.alias("bucket"), F.lit(late).alias("late"), F.lit(own).alias("own"))
    copies = F.array_compact(F.array(
        place(F.col("_bucket"), False, True),
        F.when(F.coalesce(is_edge, F.lit(False)) & (F.col(id_col) < F.lit(top)), place(F.col("_bucket") + 1, False, False)),
        F.when(F.col(id_col) == F.lit(top), place(F.lit(0), True, False))))
    order = Window.partitionBy("_to.bucket").orderBy("_to.late", F.col(id_col).desc_nulls_last(), text_col)
    spread = df.withColumn("_coarse", coarse).withColumn("_bucket", bucket).withColumn("_to", F.explode(copies)).drop("_coarse", "_bucket")
    return (spread.withColumn("next_text", F.coalesce(F.lead(text_col).over(order), F.first(text_col).over(order.rowsBetween(Window.unboundedPreceding, 0))))
            .where("_to.own").drop("_to"))


def fingerprint_table(documents: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its edited text (its second half replaced by the next document's
    beginning) and the likeness to both. Rows that share an id are documents of their own."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near = with_next(docs, "doc_id", "text").withColumn("n_chars", F.length("text").cast("long"))
    edited = near.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 2 as int)), substring(next_text, 1, cast(n_chars div 2 as int)))"))
    out = edited
    for col, name in (("text", "own"), ("edited", "new"), ("next_text", "nxt")):
        out = with_fingerprint(out, col, name)
    sets = out.withColumns({f"{n}_set": chosen(n) for n in ("own", "new", "nxt")})
    return sets.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), written("own").alias("fingerprint"), written("new").alias("edited_fingerprint"),
                       likeness("own_set", "new_set").alias("near_edited"), likeness("own_set", "nxt_set").alias("near_next"))
