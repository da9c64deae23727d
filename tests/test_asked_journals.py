"""Only journal rows that some record asks for are ranked; the result is that of the whole list."""

from biblioweave.operators import journals
from tests.test_journals import frames


def test_journal_rows_that_no_record_asks_for_are_not_ranked(spark, monkeypatch):
    records, j = frames(
        spark,
        (1, "s", "Other", "00000001, 1234-5678", 2020, None),
        (2, "s", "Annals of Fuzzy Joint", None, 2020, None),
        (3, "s", "Elsewhere", "12345678", None, None),
        (4, "s", None, None, None, None),
    )
    ranked, first = [], journals._first_metric

    def recorded(metrics, keys):
        ranked.append(sorted({r.j_ord for r in metrics.select("j_ord").collect()}))
        return first(metrics, keys)

    monkeypatch.setattr(journals, "_first_metric", recorded)
    out = {r.doc_ord: r.j for r in journals.with_metrics(records, journals.journal_rows(records, j)).collect()}
    assert ranked == [[1, 2], [4]]
    assert set(out) == {1, 2, 3, 4} and out[3] is None and out[4] is None
    assert (out[1].SJR, out[1].Categories) == (1.5, "Optics") and (out[2].SJR, out[2].Categories) == (3.5, "Sets")
