import numpy as np

from gridloom.llm import queries, spam
from gridloom.llm.trees import BaggedTrees
from gridloom.session import table

SENTENCE = "The crew of the night shift has opened the breaker in bay {} and it was closed again after the test."
WORDS = ["cheap", "fuse", "panel", "offer", "sale", "meter", "switch"]


def pages():
    rows = []
    for i in range(60):
        rows.append((i, "\n".join(SENTENCE.format(i * k) for k in range(1, 8)), "field", False))
        run = ", ".join(f"{WORDS[(i + k) % 7]} {WORDS[(i * k) % 7]}" for k in range(60))
        links = "\n".join(f"{WORDS[k % 7]} offer - https://www.{WORDS[k % 7]}-{i}.test/p/{k}.html" for k in range(15))
        tags = "\n".join(f"#{WORDS[k % 7]}_{WORDS[(k + i) % 7]}" for k in range(30))
        rows.append((100 + i, [run, links, tags][i % 3], "web", True))
        rows.append((200 + i, "\n".join(SENTENCE.format(k) for k in range(9)) + "\n" + links[:250], "web", False))
        rows.append((300 + i, SENTENCE.format(i) + "\n" + run, "web", True))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")


def test_pages_of_known_kind(spark):
    rows = pages()
    found = {r.doc_id for r in spam.spam_pages(frame(spark, rows)).collect()}
    truth = {r[0] for r in rows if r[3]}
    assert len(found & truth) / len(truth) > 0.97 and len(found - truth) <= 2


def test_odd_texts(spark):
    base = pages()
    rows = [*base, (900, None, "web"), (901, "", "web"), (902, " \n\t ", None), (903, "n/a", "web"), (904, " ".join(["cheap fuse"] * 60_000), "web"), (905, "\n".join([SENTENCE.format(1)] * 2000), "web"), (905, "\n".join([SENTENCE.format(1)] * 2000), "web"), (None, SENTENCE.format(2), "web")]
    got = spam.page_scores(frame(spark, rows)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(base) + 7
    assert 903 not in {r.doc_id for r in spam.spam_pages(frame(spark, rows)).collect()}
    assert all(by[d].score == 0 for d in (900, 901, 902)) and by[904].score == 1 and by[905].score == 0


def test_no_pages_and_one_kind_only(spark):
    assert spam.spam_pages(frame(spark, [])).count() == 0
    assert spam.spam_pages(frame(spark, [r for r in pages() if not r[3]][:20])).count() == 0


def test_trees_learn_what_is_held_out():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) & (x[:, 1] < 0.5) | (x[:, 2] > 1.2)).astype(int)
    p = BaggedTrees(trees=15).fit(x[:2000], y[:2000]).predict(x[2000:]) > 0.5
    assert (p == y[2000:]).mean() > 0.93
    assert len(BaggedTrees(trees=2).fit(x[:50], np.zeros(50, int)).predict(x[:3])) == 3


def test_weak_labels_are_stable(spark, small):
    rows = queries.p10_scores(spark, small).collect()
    assert len(rows) == table(spark, small, "documents").count()
    assert all(0 <= r.score <= 1 for r in rows)


def test_runs_of_short_pieces_are_spam_and_sheets_are_not(spark):
    base = pages()
    runs, sheets = [], []
    for i in range(30):
        words = [f"{WORDS[(i + k) % 7]} {WORDS[(k * k + i) % 7]}" if k % 3 else WORDS[(i + k) % 7] for k in range(50)]
        end = [".", "!", "?"][i % 3]
        run = " ".join(w + end for w in words)
        runs.append((1000 + i, [run, run.upper(), SENTENCE.format(i) + " " + run, SENTENCE.format(i) + "\n\n" + run, "\n".join(words)][i % 5], "web"))
        sheets.append((2000 + i, [" ", "\n"][i % 2].join(f"In bay B-{k} it is {['ok', 'open'][k % 2]}{'.' if i % 3 else ';'}" for k in range(20)), "field"))
        sheets.append((3000 + i, "\n".join(SENTENCE.format(k) for k in range(12)) + "\n\n" + " ".join(w + end for w in words[:12]), "web"))
    found = {r.doc_id for r in spam.spam_pages(frame(spark, [*base, *runs, *sheets])).collect()}
    assert {r[0] for r in runs} <= found
    assert not {r[0] for r in sheets} & found


def test_links_between_short_sentences_are_a_unit_of_their_own():
    text = "Ein Feld war offen.\n" + "\n".join(f"https://www.fuse-{k}.test/p/{k}" for k in range(9)) + "\nEs ist nun zu."
    kinds = [[p.marked for p in u] for u in spam.units(text)]
    assert kinds == [[False], [True] * 9, [False]]
    assert "".join(p.text for u in spam.units("a b. c!\n\nd? " + "e f. " * 40) for p in u) == "ab.c!d?".replace("ab", "a b") + "e f." * 40


def test_hosts_move_doubtful_units_only(spark):
    """The same pages score alike by the trees alone wherever they come from; a host full of spam never clears or condemns a sure one."""
    rows = [r[:3] for r in pages()]
    moved = {r.doc_id: r for r in spam.page_scores(frame(spark, [(d, t, "one") for d, t, _ in rows])).collect()}
    other = {r.doc_id: r for r in spam.page_scores(frame(spark, rows)).collect()}
    assert all(moved[d].score == other[d].score for d in moved)
    assert sum((r.smoothed > 0.5) != (r.score > 0.5) for r in other.values()) <= 2
