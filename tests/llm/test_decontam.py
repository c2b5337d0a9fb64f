from souk.llm import decontam

ITEM = " ".join(f"item{i} word{i * 7 % 13}" for i in range(20))
LONG = " ".join(f"long{i}" for i in range(450))


def search(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r.doc_id, r.item_id, round(r.similarity, 3)) for r in decontam.contaminated(d, b).collect()), key=str)


def test_finds_exact_and_edited_passages_and_leaves_clean_texts(spark):
    filler = " ".join(f"f{i % 97}g{i}" for i in range(3_000))
    words = ITEM.split()
    one_edit = " ".join(words[:20] + ["other"] + words[21:])
    docs = [(1, filler), (2, f"{filler}\n{ITEM.upper()} {filler}"), (3, ITEM), (4, f"{filler} {one_edit}"),
            (5, " ".join(words[:12]) + " " + filler), (6, None), (7, ""), (None, f"x {ITEM}"), (8, "one two"), (9, f"{filler} {LONG} {filler}"),
            (2, f"{filler}\n{ITEM}")]
    items = [(10, ITEM), (11, "one two"), (12, None), (13, ""), (14, LONG)]
    found = search(spark, docs, items)
    assert [(d, i) for d, i, _ in found] == [(2, 10), (2, 10), (3, 10), (8, 11), (9, 14), (None, 10)]
    assert all(s == 1.0 for *_, s in found)


def test_similarity_at_least_four_fifths(spark):
    words = [f"v{i}" for i in range(64)]
    near = words[:60] + ["a", "b", "c", "d"]                 # 56 of 60 shingles stay
    far = [w if i % 8 else f"q{i}" for i, w in enumerate(words)]
    found = search(spark, [(1, " ".join(near)), (2, " ".join(far))], [(5, " ".join(words))])
    assert [(d, i) for d, i, _ in found] == [(1, 5)] and found[0][2] >= 0.8


def test_empty_tables(spark):
    assert search(spark, [], [(1, ITEM)]) == []
    assert search(spark, [(1, ITEM)], []) == []


def test_index_misses_no_fingerprint_within_the_radius():
    import numpy as np
    rng = np.random.default_rng(1)
    parts = [(i, rng.integers(0, 1 << 63, size=30, dtype=np.uint64)) for i in range(8)]
    held = decontam._Class(parts)
    flips = [rng.choice(64, size=int(rng.integers(0, 16)), replace=False) for _ in range(300)]
    prints = np.array([int(held.prints[i % 8]) ^ sum(1 << int(b) for b in f) for i, f in enumerate(flips)], dtype=np.uint64)
    at, part = held.candidates(prints)
    assert {(i, i % 8) for i in range(300)} <= set(zip(at.tolist(), part.tolist()))


def test_many_items_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontam, "ITEMS_PER_PASS", 2)
    items = [(i, " ".join(f"p{i}x{j}" for j in range(10 + i))) for i in range(7)]
    assert [(d, i) for d, i, _ in search(spark, items, items)] == [(i, i) for i in range(7)]


def edited(text, at):
    words = text.split()
    return " ".join(words[:at] + ["other"] + words[at + 1:])


def test_edited_copies_of_repeated_and_templated_items(spark):
    filler = " ".join(f"f{i}" for i in range(300))
    twice = " ".join(f"t{i}" for i in range(50))
    template = [" ".join([f"q{j}" for j in range(40)] + [f"own{k}x{j}" for j in range(10)]) for k in range(10)]
    items = [(1, twice), (2, twice)] + [(10 + k, t) for k, t in enumerate(template)]
    docs = [(1, f"{filler} {edited(twice, 25)} {filler}"), (2, f"{filler} {edited(template[3], 20)} {filler}"), (3, f"{filler} {edited(template[4], 45)} {filler}"), (4, filler)]
    found = {(d, i): s for d, i, s in search(spark, docs, items)}
    assert found[1, 1] == found[1, 2] == 0.804                # 41 of 51 shingles
    assert found[2, 13] >= 0.8 and found[3, 14] == 0.804
    assert not any(d == 4 for d, _ in found)


def test_size_of_a_pass_changes_no_similarity(spark, monkeypatch):
    template = [" ".join([f"q{j}" for j in range(30)] + [f"own{k}x{j}" for j in range(20)]) for k in range(6)]
    items = [(k, t) for k, t in enumerate(template)] + [(9, template[0])]
    docs = [(k, "start " + " ".join("new" if j in (3, 4, 5, 6) else w for j, w in enumerate(t.split())) + " end") for k, t in enumerate(template)]
    docs += [(10 + k, edited(t, at)) for k, t in enumerate(template) for at in (10, 40)]
    whole = search(spark, docs, items)
    monkeypatch.setattr(decontam, "ITEMS_PER_PASS", 1)
    assert whole and search(spark, docs, items) == whole
    assert any(d == i for d, i, _ in whole)                  # 8 of 46 shingles are lost, all of them shared: plain 0.70


def test_short_items_are_found_inside_documents(spark):
    filler = " ".join(f"f{i}" for i in range(50))
    items = [(1, "alone"), (2, "Two words"), (3, "three words here"), (4, "exactly four words long")]
    docs = [(10 + i, f"{filler} {t} {filler}") for i, t in items] + [(20, "two"), (21, "words two"), (22, "say two words"), (23, filler)]
    found = search(spark, docs, items)
    assert [(d, i) for d, i, _ in found] == [(11, 1), (12, 2), (13, 3), (14, 4), (22, 2)] and all(s == 1.0 for *_, s in found)
