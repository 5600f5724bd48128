import random
import re

from marketlens.llm import line_dedup
from tests.llm import edges

STRIP = " \t\n\v\f\r"


def plain(rows, min_words):
    """All runs of all lengths; rows in order."""
    docs = [[(n, line) for n, line in enumerate((text or "").split("\n")) if line.strip(STRIP)] for _, text in rows]
    seen, out = set(), []
    for (_, text), own in zip(rows, docs, strict=True):
        gone, lines = set(), [x.strip(STRIP) for _, x in own]
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(lines[a:b])
                if sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in run) >= min_words:
                    if run in seen:
                        gone |= set(range(a, b))
                    seen.add(run)
        kept, go = [], False
        places = {n: k for k, (n, _) in enumerate(own)}
        for n, line in enumerate((text or "").split("\n")):
            go = places[n] in gone if n in places else go
            if not go:
                kept.append(line)
        out.append((len(lines), len(gone), None if text is None else "\n".join(kept)))
    return out


def test_same_lines_as_a_search_of_all_runs(spark):
    rng = random.Random(8)
    stock = ["a", "b c", "d e f", "g h i j", " a", "", "\t", "k l m n o p q", "b  c"]
    rows = [(k, "\n".join(rng.choice(stock[: rng.choice((3, 9))]) for _ in range(rng.randint(0, 14)))) for k in range(60)]
    for least in (1, 4, 9):
        found = {r.doc_id: (r.n_lines, r.n_deleted, r.text) for r in line_dedup.dedup_lines(edges.frame(spark, rows), min_words=least).collect()}
        assert found == {k: v for (k, _), v in zip(rows, plain(rows, least), strict=True)}


def test_edges(spark):
    docs = edges.frame(spark, edges.rows())
    found = line_dedup.dedup_lines(docs)
    assert set(found.columns) == {*docs.columns, "n_deleted"} and found.count() == docs.count()
    rows = [(r.doc_id, r.n_lines, r.n_deleted, r.text) for r in found.collect()]
    first = [r for r in rows if r[0] is None and r[1]]
    assert first[0][2] == 0  # null ids come first, so theirs is the copy that stays
    assert all(r[2] > 0 for r in rows if r[0] in (5, 6)) and sum(r[0] == 6 for r in rows) == 2
    assert [r for r in rows if r[0] == 1] == [(1, 0, 0, None)] and [r for r in rows if r[0] == 2] == [(2, 0, 0, "")]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_long_repeats_and_a_hot_line(spark):
    hot = "this very line stands in every text of the whole table"
    passage = "\n".join(f"line {k} of a passage that two texts share word for word" for k in range(200))
    rows = [(k, f"{hot}\nown words {k} and some more of them to make a line\n{hot}") for k in range(300)]
    rows += [(400, passage), (401, f"intro words\n{passage}\noutro words")]
    found = {r.doc_id: r for r in line_dedup.dedup_lines(edges.frame(spark, rows)).collect()}
    assert sum(r.n_deleted for r in found.values()) == 2 * 300 - 1 + 200
    assert found[401].text == "intro words\noutro words" and found[0].n_deleted == 1
