from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from refinery.llm import paragraphs as P
from tests.llm.helpers import documents, empty, words


def plain(rows, threshold=0.8):
    members = [(k, i, p) for k, t in rows if k is not None for i, p in enumerate(map(" ".join, P.split(t or "")))]
    label = list(range(len(members)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    sets = [P.shingles(m[2]) for m in members]
    for i in range(len(members)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                label[find(i)] = find(j)
    groups = defaultdict(list)
    for i, m in enumerate(members):
        groups[find(i)].append(m[:2])
    return sorted((k, i, len(g), *min(g), (k, i) != min(g)) for g in groups.values() if len(g) > 1 for k, i in g)


def found(df):
    return sorted((r["doc_id"], r["paragraph"], r["class_size"], r["kept_id"], r["kept_paragraph"], r["removed"]) for r in df.collect())


def sentence(n, seed):
    return " ".join(words(n, seed, 900)).capitalize() + "."


def table():
    passage = " ".join(sentence(14, s) for s in (1, 2, 3, 4))
    long = sentence(60, 8).split()
    near = [" ".join(long[:i] + ["edit"] + long[i + 1:]) for i in range(1, 59, 2)]
    rows = [(i, f"{sentence(12, 100 + i)} Oh no. {passage} {sentence(15, 200 + i)}\n{sentence(9, 300 + i)}") for i in range(6)]
    rows += [(40 + i, t) for i, t in enumerate(near)]
    rows += [(90, None), (91, ""), (92, "To an. " * 40), (93, "To an. " * 30), (None, passage), (94, f"{sentence(20, 5)}\n{sentence(20, 5)}"), (95, sentence(20, 6)), (95, sentence(20, 6)),
             (96, " ".join(words(20000, 7))), (97, "w " * 9)]
    return rows


def test_against_all_pairs(spark, monkeypatch):
    rows = table()
    want = plain(rows)
    got = found(P.duplicates(documents(spark, rows), recall=0.9999))
    assert got == want and {0, 1, 2, 3, 4, 5} <= {w[0] for w in want}
    monkeypatch.setattr(P, "BUCKET", 3)
    monkeypatch.setattr(P, "MOST_WORDS", 64)
    assert found(P.duplicates(documents(spark, rows), recall=0.9999)) == want
    assert P.duplicates(empty(spark)).count() == 0


def test_clean_documents_are_left_alone(spark):
    rows = [(i, f"{sentence(30, 700 + i)} {sentence(40, 800 + i)}") for i in range(30)]
    assert P.duplicates(documents(spark, rows)).count() == 0


def test_bands_reach_the_recall():
    assert P.tune(0.8, 0.99) == (3, 1)
    for threshold, recall in ((0.5, 0.9), (0.8, 0.999), (0.9, 0.95)):
        b, r = P.tune(threshold, recall)
        assert 1 - (1 - threshold ** r) ** b >= recall


def test_paragraphs_meet_again_after_the_first_sentence():
    passage = " ".join(sentence(11, s) for s in range(5))
    cuts = [{" ".join(p) for p in P.split(lead + passage + tail)} for lead, tail in (("", ""), ("Oh. No w. ", " Ha."), ("some words before it ", " and after"))]
    assert len(set.intersection(*cuts)) >= 3


def test_fifty_words_are_found_wherever_they_are_spliced(spark):
    rows = []
    for n in range(12):
        passage = words(50, 900 + n, 900)
        if n % 3 == 1:
            passage[9 + n] += "."
        for side in range(2):
            before, after = words(30 + 7 * n + side, 1000 + 2 * n + side, 900), words(45, 1100 + 2 * n + side, 900)
            inner = "\n".join(passage) if side and n % 2 else " ".join(passage)
            rows.append((2 * n + side, " ".join(before) + " " + inner + " " + " ".join(after) + ("." if n % 4 else "")))
    got = found(P.duplicates(documents(spark, rows)))
    assert {g[0] for g in got} == set(range(24)) and all(g[0] // 2 == g[3] // 2 for g in got)
    again = P.duplicates(documents(spark, [(1, "x " + " ".join(["again"] * 300))])).collect()
    assert len(again) == 11 and sum(not r["removed"] for r in again) == 1  # windows that do not overlap


def test_short_lines_and_tails_are_compared(spark):
    verse = "\n".join(" ".join(words(5, 1300 + i, 900)) for i in range(7))
    rows = [(1, verse), (2, verse), (3, f"{sentence(12, 1400)}\n{verse}\n{sentence(14, 1401)} So it ends."), (4, f"{sentence(20, 1402)} So it ends."),
            (5, "Short text."), (6, "short  TEXT."), (7, f"Short\n\n{sentence(9, 1403)}")]
    assert {1, 2, 3, 4, 5, 6} == {g[0] for g in found(P.duplicates(documents(spark, rows)))}
    for _, text in rows + table():
        pieces = [" ".join(p).replace(P.GLUE, " ") for p in P.split(text or "") if len(p) > 1 or p[0].count(P.GLUE) < P.LEAST_WORDS]
        assert sorted(" ".join(pieces).split()) == sorted((text or "").lower().split())


def bodies(spark, rows):
    """Variants (uid, body, keys) that all share one key."""
    return spark.createDataFrame([(i, b, [77]) for i, b in enumerate(rows)], "uid long, body string, keys array<long>")


def test_paragraphs_around_one_template_part(spark):
    template = " ".join(words(12, 50, 9000))
    own = lambda i, at: " ".join(f"w{i}x{j}" for j in range(at, at + 8))
    rows = [f"{own(i, 0)} {template} {own(i, 8)}" for i in range(1200)]
    rows[7] = rows[1100] + " more"
    hot = bodies(spark, rows).selectExpr("77L AS key", "uid", "body")
    meeting = P.rare_prefixes(hot, 0.8, "t").groupBy("key").count().where("count > 1").collect()
    assert sum(r["count"] for r in meeting) <= 20  # 1,200 members share a key; those that still meet are the two alike
    assert [(r["src"], r["dst"]) for r in P.links(bodies(spark, rows), 0.8, "t").collect()] in ([(7, 1100)], [(1100, 7)])


def test_crowds_are_linked_whole(spark, monkeypatch):
    def classes(edges, n):
        label = list(range(n))
        for a, b in edges:
            old, new = label[a], label[b]
            label = [new if x == old else x for x in label]
        return sorted(sorted(i for i in range(n) if label[i] == x) for x in set(label))

    base, other = words(60, 70, 9000), words(60, 71, 9000)
    rows = [" ".join(base[:i % 58] + [f"edit{i}"] + base[i % 58 + 1:]) for i in range(90)]  # linked only where edits are near
    rows += [" ".join(base[:30] + other[30 + i % 9:]) for i in range(30)] + [" ".join(base[:45] + other[45:58]), " ".join(base)]
    sets = [P.shingles(r) for r in rows]
    alike = [(i, j) for i in range(len(rows)) for j in range(i)
             if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for bucket, turns in ((4, 3), (4, 1), (7, 0), (256, 3)):
        monkeypatch.setattr(P, "BUCKET", bucket)
        monkeypatch.setattr(P, "TURNS", turns)
        got = [(r["src"], r["dst"]) for r in P.links(bodies(spark, rows), 0.8, "t").collect()]
        assert classes(got, len(rows)) == classes(alike, len(rows))
        assert {tuple(sorted(g)) for g in got} <= {tuple(sorted(a)) for a in alike}


def test_recall_of_the_registered_setting(spark):
    rows, n = [], 300
    for i in range(n):
        ws = [f"w{i}x{j}" for j in range(60)]
        rows += [(2 * i, " ".join(ws).capitalize() + "."), (2 * i + 1, " ".join(ws[:29] + [f"edit{i}"] + ws[30:]).capitalize() + ".")]
    sets = [P.shingles(" ".join(P.split(t)[0])) for _, t in rows[:2]]
    assert 0.8 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.85
    got = P.duplicates(documents(spark, rows)).where("paragraph = 0 and removed").count()
    assert got >= 0.97 * n


def test_removal_leaves_the_other_words(spark):
    rows = table() + [(7, sentence(30, 5)), (7, rows_text := table()[1][1]), (None, sentence(20, 5)), (8, f"\u0130 {sentence(20, 5)}  {sentence(20, 5)}\n\tEnd")]
    docs = documents(spark, rows).withColumn("removed_spans", F.lit(1))
    got = P.duplicates(docs)
    units = defaultdict(list)
    for r in got.where("removed").collect():
        units[r["doc_id"]].append(r)
    left = P.remove(docs, got)
    assert left.columns == docs.columns and left.schema["text"] == docs.schema["text"]
    want = []
    for key, text in rows:
        ws = (text or "").lower().split()
        gone = set()
        for r in units[key] if key is not None else ():
            part = ws[r["first_word"]:r["first_word"] + r["words"]]
            if part and [x for x in P.split(text) if x == part or x == [P.GLUE.join(part)]] and r["unit"] in hashes(part):
                gone |= set(range(r["first_word"], r["first_word"] + r["words"]))
        want.append((key, [w for i, w in enumerate(ws) if i not in gone]))
    seen = [(r["doc_id"], (r["text"] or "").lower().split()) for r in left.collect()]
    assert sorted(seen, key=repr) == sorted(want, key=repr)
    assert any(len(w) < len((t or "").split()) for (_, w), (_, t) in zip(want, rows)) and rows_text.lower().split() not in [w for _, w in want[1:]]
    old = defaultdict(list)
    for k, t in rows:
        old[k].append(t)
    for r in left.collect():
        cut = ["".join(t[a:b] for a, b in zip([0, *[s["end"] for s in r["removed_spans"]]], [*[s["start"] for s in r["removed_spans"]], len(t)]))
               if t else t for t in old[r["doc_id"]]]
        assert r["text"] in cut
    assert P.remove(empty(spark), P.duplicates(empty(spark))).count() == 0


def hashes(part):
    found = [xxhash.xxh3_64_intdigest(glue.join(part)) for glue in (" ", P.GLUE)]
    return [h - (1 << 64) if h >> 63 else h for h in found]
