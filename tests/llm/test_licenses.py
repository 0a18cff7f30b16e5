import re

from dimweave.llm import licenses
from dimweave.llm.license_texts import PHRASES, TEXTS
from helpers import DOCS, LOWER, frame

LICENSE = {label: text for label, text in TEXTS}
MIT = LICENSE["mit"]
LONG = " ".join(f"w{i}" for i in range(9_000))
OWN = [
    (100, "Released UNDER the-MIT\n License. Under the MIT license, Apache License Version 2.0 and CC BY-NC 4.0"),
    (101, f"{LONG} {MIT} {LONG}"), (102, " ".join(MIT.split()[:60])), (103, "the mit license under"),
    (104, MIT.replace("sublicense and", "sublicense or in any other way and").replace("furnished", "given")),
    (105, "This work is licensed under the GNU General Public License, version 3."), (105, "Under the MİT license"),
    (106, "under the mit license " * 500), (107, "cc by"), (108, f"{MIT} and {LICENSE['isc']}"), (None, "cc-by-nc"), (None, "cc-by-nc"),
]


def brute(text):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER).decode())
    places = sorted((i, label) for label, p in PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    return len(w), len(places), *((places[0][0], places[-1][0]) if places else (None, None)), ",".join(sorted({x for _, x in places}))


def test_base_equals_brute_force_and_notices_are_found(spark):
    rows = DOCS + OWN
    got = licenses.digest(licenses.scan(frame(spark, rows))).collect()
    base = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr)
    assert base == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    labels = {(r.doc_id, r.n_words): (r.labels, r.score) for r in got}
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and 100 <= r.doc_id}
    assert by_id[100].labels == "apache-2,cc-by-nc,mit" and by_id[100].score == 1.0
    assert by_id[101].labels == "mit" and by_id[101].n_base == 0 and by_id[101].score == 1.0
    assert by_id[102].labels == "" and 0.2 < by_id[102].score < 0.8
    assert by_id[104].labels == "mit" and 0.9 < by_id[104].score < 1.0  # inserted and changed words
    assert labels[(105, 12)] == ("gpl-3", 1.0)  # not gpl-2, which covers less of the same place
    assert by_id[106].n_base == 500 and by_id[106].last_word == 499 * 4
    assert by_id[108].labels == "isc,mit" and by_id[103].labels == "" and by_id[107].score == 0
    assert labels[(4, 60)] == ("", 0.0)


def test_without_a_look_up_and_without_a_broadcast(spark, monkeypatch):
    rows = DOCS + OWN
    first = sorted((tuple(r) for r in licenses.digest(licenses.scan(frame(spark, rows))).collect()), key=repr)
    monkeypatch.setattr(licenses, "LOOKED_UP", 5)
    monkeypatch.setattr(licenses, "BROADCAST_POSITIONS", 5)
    assert sorted((tuple(r) for r in licenses.digest(licenses.scan(frame(spark, rows))).collect()), key=repr) == first


def test_own_templates_spans_and_empty_tables(spark):
    found = licenses.scan(frame(spark, [(1, "x one two three four x one two three four")]), [("p", "one two three")],
                          [("t", "two three four five")]).collect()[0]
    assert [(b.start, b.end, b.label) for b in found.base] == [(1, 4, "p"), (6, 9, "p")] and found.spans == [] and found.score == 1.0
    assert licenses.scan(frame(spark, [])).count() == 0
    assert licenses.scan(frame(spark, [(1, "under the mit license")]), [], []).collect()[0].score == 0.0


def test_no_python_workers(spark):
    plan = licenses.digest(licenses.scan(frame(spark)))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
