"""Small inputs that every operator must bear: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import random

CLASH = "id string, key string, fp long, found string, score string, component_id string, runs string, mask string, no string"
N_CLASH = CLASH.count(",") + 1


def documents(spark, rows):
    """A documents table of (doc_id, text) with further columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, *(["x"] * 2), 7, *(["x"] * (N_CLASH - 3))) for i, t in rows],
                                 f"doc_id long, text string, {CLASH}")


def empty(spark):
    return documents(spark, [])


def words(n, seed=0, size=400):
    rng = random.Random(seed)
    bag = ["".join(rng.choices("abcdefghiklmnoprstu", k=rng.randint(2, 9))) for _ in range(size)]
    return [rng.choice(bag) for _ in range(n)]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
