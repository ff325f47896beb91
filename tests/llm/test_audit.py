from itertools import permutations

import pytest

from farestar.llm import audit
from farestar.llm.oracle import all_sql
from farestar.llm.queries import op11_audit
from harness.compare import differences

LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    """(part, failed filters, doc_id) of (doc_id, text, source) rows, one by one."""
    found = []
    for doc_id, text, source in rows:
        text = text or ""
        words = text.encode().split()
        failed = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows),
        }
        found.append((source or "", {name for name, fails in failed.items() if fails}, doc_id))
    return found


def plain_audit(rows, labels):
    found = failures(rows)
    good, toxic = ({d for d, *marks in labels if marks[i] == 1 and d is not None} for i in (0, 1))
    result = set()
    for part in {p for p, *_ in found}:
        mine = [(f, d) for p, f, d in found if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                before = set(order[:step - 1])
                removed = [d for f, d in mine if name in f and not f & before]
                shapley[name] += len(removed)
                steps.append((
                    "".join(order), step, name, sum(not f & (before | {name}) for f, _ in mine), len(removed),
                    sum(name in f and bool(f & before) for f, _ in mine), sum(f == {name} for f, _ in mine),
                    sum(d in good for d in removed), sum(d in toxic for d in removed),
                ))
        result |= {(part, order, step, *counts, shapley[name]) for order, step, name, *counts in steps}
    return result


@pytest.fixture
def audited(spark):
    def build(rows, labels):
        docs = spark.createDataFrame(
            [(d, t, s, 1, "x", 0) for d, t, s in rows],
            "doc_id long, text string, source string, bits int, hash string, good int",
        ).repartition(3)
        return {tuple(r) for r in audit.audit(docs, spark.createDataFrame(labels, LABELS)).collect()}

    return build


def test_audit_equals_brute_force(audited, odd_rows, prose):
    sources = ["a", "b", None, ""]
    rows = [(d, t, sources[i % 4]) for i, (d, t) in enumerate(odd_rows)]
    rows += [(100 + i, prose(i % 3) + (" #" if i % 5 == 0 else ""), sources[i % 2]) for i in range(20)]
    rows += [(200 + i, prose(i).upper() * (i % 2 + 1), "hot") for i in range(6)]
    rows += [(300 + i, "the same text " * 30, "hot") for i in range(40)] + [(7, prose(5), "hot")]
    labels = [(i, i % 2, i % 3 % 2) for i in range(0, 340, 2)] + [(8, 0, 1), (8, 1, None), (None, 1, 1)]
    expected = plain_audit(rows, labels)
    assert len(expected) == 600 * 4 and audited(rows, labels) == expected


def test_a_row_is_no_copy_of_itself(audited, prose):
    rows = [(1, prose(1), "s"), (1, prose(1), "s"), (None, prose(1), "s"), (None, prose(1), "s")]
    found = [r for r in audited(rows, []) if r[1] == "EABCD" and r[2] == 1]
    assert found == [("s", "EABCD", 1, 4, 0, 0, 0, 0, 0, 0)]


def test_audit_of_an_empty_table(audited):
    assert audited([], []) == set()


def test_audit_equals_its_sql(spark, sf_dir):
    assert differences(op11_audit(spark, sf_dir), sf_dir, all_sql()["op11_audit"]) is None
