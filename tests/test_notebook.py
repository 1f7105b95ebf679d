import json

from leafmill.operators.long_tables import cells
from leafmill.operators.routes import notebook_documents
from leafmill.options import ParseOptions


def _nb(*cells):
    return json.dumps({"cells": list(cells), "nbformat": 4}).encode()


def _text(files, data, **opts):
    (row,) = notebook_documents(files(("n.ipynb", data)), ParseOptions(**opts)).collect()
    return row


def test_document(files):
    row = _text(
        files,
        _nb(
            {"cell_type": "markdown", "source": ["# T\n", "text "]},
            {
                "cell_type": "code",
                "source": "x = 1\n",
                "outputs": [
                    {"output_type": "stream", "text": ["a\n", "b\n"]},
                    {"output_type": "execute_result", "text": "", "data": {"text/plain": " one "}},
                    {"output_type": "display_data", "text": [], "data": {"text/plain": ["t", "wo"], "image/png": "iV"}},
                    {"output_type": "display_data", "data": {"image/png": "iV"}},
                    {"output_type": "error", "ename": "E", "traceback": ["x"]},
                    {"output_type": "stream", "text": "  "},
                ],
            },
            {"cell_type": "raw", "source": "dropped"},
            {"source": "no type"},
            {"cell_type": "code"},
        ),
    )
    assert row.text == (
        "# T\ntext\n\n```python\nx = 1\n```\n```output\na\nb\n```\n```output\none\n```\n```output\ntwo\n```\n\n"
        "```python\n\n```"
    )
    assert row.meta.format == "Jupyter Notebook" and row.type == "ipynb"


def test_cells(files):
    data = _nb({"cell_type": "", "source": ["a", "b"]}, {"cell_type": "code", "source": None, "outputs": [{"text": "o"}]})
    rows = sorted(cells(files(("n.ipynb", data))).collect(), key=lambda r: r.pos)
    assert [(r.pos, r.cell_type, r.source, r.outputs) for r in rows] == [(0, "unknown", "ab", []), (1, "code", "", ["o"])]


def test_limits(files):
    many = [{"cell_type": "markdown", "source": str(i)} for i in range(201)]
    assert "not processed" not in _text(files, _nb(*many[:200])).text
    text = _text(files, _nb(*many)).text
    assert text.endswith("199\n\n[... 1 more cell(s) not processed. Use maxPages to increase limit.]")
    assert _text(files, _nb(*many[:3]), max_pages=1).text.startswith("0\n\n[... 2 more cell(s)")


def test_bad_and_empty(files):
    for data in (b"{", b"not json", b'{"cells": [}'):
        row = _text(files, data)
        assert row.text == "Invalid JSON: Could not parse notebook file." and row.meta.format == "IPYNB"
        assert row.total_chars == len(row.text)
    for data in (b"{}", b'{"cells": []}', b"[]"):
        row = _text(files, data)
        assert row.text == "" and row.meta.format == "Jupyter Notebook"
