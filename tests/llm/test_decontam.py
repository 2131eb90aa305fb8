from hypothesis import given, settings, strategies as st

from refinery.llm import decontam
from tests.llm.helpers import documents, rows_of, words


def fewest(pattern, text):
    """Edit distance between the pattern and the nearest passage of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, id string, distance string")


@given(st.text("ab c", min_size=1, max_size=14), st.text("ab c", max_size=40))
@settings(max_examples=150, deadline=None)
def test_bit_parallel_distance(pattern, text):
    masks = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    assert decontam.distance(masks, len(pattern), text, len(pattern)) == fewest(pattern, text)


@given(st.text("ab", min_size=8, max_size=16), st.text("ab", max_size=40))
@settings(max_examples=150, deadline=None)
def test_pieces_miss_nothing(item, text):
    best = fewest(item, text)
    assert decontam.Matcher([item], 0.2).find(text) == ([(0, best)] if best <= int(0.2 * len(item)) else [])


def test_copies_of_an_item_do_not_enlarge_a_block(spark):
    texts = [" ".join(words(12, n)) for n in range(30)]
    rows = [(i, texts[0].upper() if i % 2 else texts[0] + " ") for i in range(400)] + [(1000 + n, t) for n, t in enumerate(texts)]
    named = decontam.named_items(items(spark, [(i, t, "x", "x") for i, t in rows]), "item_id", "text")
    most = sum(map(len, texts)) // 3
    blocks = list(decontam.text_blocks(named, most))
    assert sorted(t for _, b in blocks for t in b) == sorted(texts) and [last for last, _ in blocks] == [False] * (len(blocks) - 1) + [True]
    assert max(sum(map(len, b)) for _, b in blocks) < 2 * most
    got = decontam.matches(documents(spark, [(1, texts[0])]), items(spark, [(i, t, "x", "x") for i, t in rows]), block_chars=most)
    assert rows_of(got, "item_id") == sorted([(i,) for i in range(400)] + [(1000,)], key=repr)


def test_matches_of_a_table(spark):
    item = words(40, 1)
    whole, other = " ".join(item), " ".join(words(40, 2))
    near = whole[:30] + "Z" + whole[31:90] + whole[92:]
    far = " ".join(w if i % 3 else "zzzz" for i, w in enumerate(item))
    lead = " ".join(words(200, 9))
    rows = [(1, f"{lead} {whole} tail"), (2, near.upper()), (3, far), (4, None), (5, ""), (6, other.replace(" ", " \n")),
            (None, whole), (1, f"{lead} {whole} tail"), (7, " ".join(words(40000, 11)))]
    bench = items(spark, [(10, whole, "x", "x"), (11, whole, "x", "x"), (12, other, "x", "x"), (13, None, "x", "x"), (14, "", "x", "x")])
    for block in (10, 10**6):
        got = decontam.matches(documents(spark, rows), bench, block_chars=block)
        assert rows_of(got, "doc_id", "item_id", "distance") == sorted(
            [(k, i, 0) for k in (1, 1, None) for i in (10, 11)] + [(2, 10, 3), (2, 11, 3), (6, 12, 0)], key=repr)
        left = decontam.keep_clean(documents(spark, rows), bench, block_chars=block)
        assert rows_of(left, "doc_id") == sorted([(3,), (4,), (5,), (7,)], key=repr)
    assert decontam.matches(documents(spark, []), bench).count() == 0
    assert decontam.matches(documents(spark, rows), items(spark, [])).count() == 0
    assert decontam.keep_clean(documents(spark, rows), items(spark, [])).count() == len(rows)
