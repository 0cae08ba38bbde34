"""Small fixtures shared by the tests of the training-data operators."""

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows, schema=DOC):
    """Documents from (doc_id, text[, lang[, source]]) tuples."""
    full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, schema)


def clashing(df):
    """The same table with extra columns whose names clash with the operators' own or differ by case only."""
    from pyspark.sql import functions as F
    extra = ["size", "shard", "fp", "root", "component_id", "target", "copies", "spans", "TEXT", "Doc_Id", "c0", "n", "label_", "seed", "keep"]
    out = df
    names = list(df.columns)
    for x in extra:
        if x not in names:
            names.append(x)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.lit("zzz") for _ in names[len(df.columns):]]).toDF(*names)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is not None, str(type(x)), x) if not isinstance(x, list) else (True, "", str(x)) for x in t))


def union_find(n, pairs):
    p = list(range(n))

    def find(i):
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        p[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
