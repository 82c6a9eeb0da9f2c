"""Plain versions and small tables the operators are held against."""
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words(text)
    if len(w) < k:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1))


def component_ids(rows, k, percent):
    """Smallest id reachable by links, over all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = list(range(len(sets)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[top(a)] = top(b)
    best = {}
    for k_, (i, _) in enumerate(sets):
        best[top(k_)] = min(best.get(top(k_), i), i)
    return sorted((i, len(s), best[top(k_)]) for k_, (i, s) in enumerate(sets))


def crc(i):
    return zlib.crc32(str(i).encode())
