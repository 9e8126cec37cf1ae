import numpy as np
import pyarrow as pa
from cases import SCHEMA, awkward, table
from journeyline.llm import textkit, toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = [("idiot", False), ("moron", False), ("scum", False), ("éstem", True), ("trash", False)]
    a = toxicity.Automaton.build(terms)
    rng = np.random.default_rng(1)
    forms = ["idiot", "idiott", "idot", "xidiot", "idxiot", "moron", "moro", "morrron", "scum", "scun", "scums", "trash", "tras", "trashes", "éstem", "éstemhood",
             "ésten", "a", "idiots", "odiot", "dio", "oron"]
    forms += ["".join(rng.choice(list("idotmrnscuah"), rng.integers(1, 8))) for _ in range(3000)]
    forms += [t[:i] + c + t[i + d:] for t, _ in terms for i in range(len(t) + 1) for c in ("", "q", "i") for d in (0, 1)]
    forms = [f for f in forms if f]
    for i, rows, data, offsets in textkit.pieces(pa.array(forms)):
        start, end = offsets[:-1], offsets[1:]
        hit, term, edits = a.match(data, start, end)
        found = dict(zip(hit.tolist(), zip(term.tolist(), edits.tolist())))
        for k in range(rows):
            word = forms[i + k].encode()
            best = []
            for n, (t, stem) in enumerate(terms):
                if stem and word.startswith(t.encode()):
                    best.append((0, n))
                elif not stem:
                    d = distance(word, t.encode())
                    if d == 0 or d == 1 and len(t.encode()) >= toxicity.EDIT_FROM:
                        best.append((d, n))
            assert (k in found) == bool(best), forms[i + k]
            if best:
                assert found[k][1] == min(best)[0] and (found[k][1], found[k][0]) in best


def weights(texts):
    a = toxicity.Automaton.build([(w, False) for w in toxicity.SEEDS])
    return np.concatenate([toxicity.features(d, o, a, len(toxicity.SEEDS)) for _, _, d, o in textkit.pieces(pa.array(texts))])[:, len(toxicity.SEEDS)]


def test_context():
    plain, quoted, curly, reported, addressed, other_line, misspelt = weights(
        ["the idiot went", 'the "idiot went', "the “idiot” went", "she said idiot went", "you idiot went", 'a "\nthe idiot went', "the idiiot went"])
    assert np.allclose([plain, other_line], np.log(2)) and quoted == curly < plain and reported < plain < addressed and misspelt < plain


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.toxicity(docs, labels)
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95
    bad, good = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([x > y for x in bad for y in good]) > 0.9


def test_awkward_rows_without_labels(spark):
    rows = awkward() + [(9000, "you idiot, you moron", None, None, 0, "", 0, 0, "")]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(table(spark, rows), none).collect()}
    assert got[9000].predicted == 1 and got[3001].predicted == 0 and got[3001].score == got[3002].score
    assert all(0 <= r.score <= 1 for r in got.values())
    assert toxicity.toxicity(spark.createDataFrame([], SCHEMA), none).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (0, 1, None), (0, 1, 1), (0, 1, 0), (77, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(table(spark, rows), odd).count() == len(rows)


def test_stems_take_an_edit():
    terms = [("idiot", True), ("idiotic", False), ("worth", True), ("worthless", False), ("éclat", True), ("scum", True)]
    a = toxicity.Automaton.build(terms, stem_edits=True)
    rng = np.random.default_rng(2)
    forms = [t[:i] + c + t[i + d:] + more for t, _ in terms for i in range(len(t) + 1) for c in ("", "q", "o", "é") for d in (0, 1) for more in ("", "s", "hood")]
    forms += ["".join(rng.choice(list("idotwrhlescué"), rng.integers(1, 9))) for _ in range(3000)]
    forms = [f for f in forms if f]
    for i, rows, data, offsets in textkit.pieces(pa.array(forms)):
        hit, term, edits = a.match(data, offsets[:-1], offsets[1:])
        found = dict(zip(hit.tolist(), zip(term.tolist(), edits.tolist())))
        for k in range(rows):
            word, best = forms[i + k].encode(), []
            for n, (t, stem) in enumerate(terms):
                d = min(distance(word[:m], t.encode()) for m in (range(len(word) + 1) if stem else [len(word)]))
                if d == 0 or d == 1 and len(t.encode()) >= toxicity.EDIT_FROM:
                    best.append((d, stem, n))
            assert found.get(k) == ((min(best)[2], min(best)[0]) if best else None), forms[i + k]


def learned_from(spark, term):
    rows = [(i, f"plain words number {i} stand here" + (f" with {term} in it" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    rows += [(1000, "plain words stand here with gruxsomely in it", 0), (1001, "plain words stand here with grusomelyst in it", 0), (1002, "plain words stand here", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.where("doc_id < 1000").select("doc_id", "toxic")


def test_misspelt_learned_terms_are_found(spark):
    docs, labels = learned_from(spark, "gruesomely")
    assert "gruesomely" not in toxicity.SEEDS
    terms = toxicity.learned_terms(docs.join(labels, "doc_id").select("text", "toxic"))
    assert ("gruesomely", False) in terms and any(stem and "gruesomely".startswith(w) for w, stem in terms)
    score = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    assert score[1000] > score[1002] and score[1001] > score[1002]


def test_terms_come_from_all_labelled_rows(spark):
    docs, labels = learned_from(spark, "gruesomely")
    size, toxicity.SAMPLE = toxicity.SAMPLE, 20  # too few for LEAST_DOCS toxic documents
    try:
        score = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    finally:
        toxicity.SAMPLE = size
    assert score[0] > score[1002] and score[1000] > score[1002]


def test_lexicon_and_automaton_are_bounded(spark):
    rng = np.random.default_rng(4)
    insults = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 9)) for _ in range(900)] + ["q" * 60]
    rows = [(" ".join(insults), 1)] * toxicity.LEAST_DOCS + [("plain words", 0)] * 200
    terms = toxicity.learned_terms(spark.createDataFrame(rows, "text string, toxic int"))
    size = [len(t.encode()) for t, _ in terms]
    assert len(terms) > 150 and sum(size) <= toxicity.LEXICON_BYTES and max(size) <= toxicity.TERM_BYTES
    terms = terms[:120]
    a = toxicity.Automaton.build(terms, stem_edits=True)
    nodes = len({t.encode()[:k] for t, _ in terms for k in range(len(t.encode()) + 1)})
    d, s = max(size), a.step.shape[1] - 1
    assert len(a.step) <= 2 + 2 * len(terms) + nodes * (1 + d + d * s + (d + 1) * (s + 1))
