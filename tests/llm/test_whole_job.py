"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from starsmelt.llm import quality_classifier


def test_labels_beyond_two_thousand_are_fitted(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(quality_classifier, "train", lambda rows, settings: fitted.extend(rows))
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('word', id % 7, ' other') AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS quality").filter(
        ~quality_classifier.held_out(docs["doc_id"]))
    given = labels.count()
    assert 2000 < given <= 4000
    quality_classifier.fit(docs, labels)
    assert len(fitted) == given


def test_narrow_features_read_back():
    for values in ([], [0, 65535], [3, 65536, 1 << 20]):
        packed = quality_classifier._narrow(np.array(values, np.int64))
        assert quality_classifier._widened(pa.py_buffer(packed), len(values)).tolist() == values


def test_repeated_ids_are_fitted_once(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(quality_classifier, "train", lambda rows, settings: fitted.append(
        [(a.tolist(), b.tolist(), label) for a, b, label in rows]))
    rows = [(k, f"text number {k}") for k in range(30)]
    rows += [(7, f"another text {k}") for k in range(50)] + [(7, "text number 7")] * 20 + [(7, None)]
    labels = spark.range(30).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    used = labels.filter(~quality_classifier.held_out(labels["doc_id"]))
    assert used.filter("doc_id = 7").count() == 1
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(5)
        quality_classifier.fit(docs, labels)
    assert len(fitted[0]) == used.count() and fitted[0] == fitted[1]
