"""Corpora derived from the given tables, whole tables each.

Packages group a bounded run of neighbouring keys, so no package grows with one hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpora.pack import member, packed, xml_escape
from leafmill.sources.files import files_from_table

DOCS_PER_ARCHIVE = 50
DOCS_PER_CSV = 20
ORDERS_PER_TSV = 500
CUSTOMERS_PER_BOOK = 50
TURNS_PER_PART = 50
PAGES_PER_BOOK = 10

# Fixed value: suffixes that the text corpus cycles through.
SUFFIXES = ["txt", "md", "json", "yaml", "yml", "toml", "ini", "cfg", "log", "xml"]


def spread(scan: DataFrame) -> DataFrame:
    """A table scan over at least as many partitions as there are cores.

    Extraction is bound by CPU, and a table in few row groups would leave cores idle.  Rows are
    dealt out evenly, so hot keys do not matter; a scan that already has enough partitions, as any
    large table has, is left alone and nothing is shuffled.  For scans only: counting the
    partitions of a plan with shuffles would run them.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(wanted) if scan.rdd.getNumPartitions() < wanted else scan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def text_of(value: Column) -> Column:
    return value.cast("string")


def pick(items: list, key: Column) -> Column:
    """One of the items per row, by key."""
    lits = [F.lit(bytes(i) if isinstance(i, (bytes, bytearray)) else i) for i in items]
    return F.get(F.array(*lits), F.pmod(key, F.lit(len(items))).cast("int"))


def docs(spark: SparkSession, sf_dir: str, suffixes: list[str] = SUFFIXES) -> DataFrame:
    """One text file per document; suffixes cycle over the keys."""
    path = F.concat(F.lit("corpus/doc_"), text_of(F.col("doc_id")), F.lit("."), pick(suffixes, F.col("doc_id")))
    return files_from_table(table(spark, sf_dir, "documents"), path, F.col("text"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("web/page_"), text_of(F.col("page_id")), F.lit(".html"))
    return files_from_table(table(spark, sf_dir, "pages"), path, F.col("html"))


def _conversation_parts(spark: SparkSession, sf_dir: str, *fields: Column) -> DataFrame:
    """name and ordered turns of every bounded part of a conversation."""
    turns = table(spark, sf_dir, "conversations").withColumn("part", F.floor(F.col("turn") / TURNS_PER_PART))
    return (
        turns.groupBy("conv_id", "part")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", *fields))).alias("turns"))
        .withColumn("name", F.concat_ws("_", F.lit("conv"), "conv_id", "part"))
    )


def notebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One notebook per conversation part, and a cut-off copy of those with a system turn.

    User turns are markdown, assistant turns code with outputs, system turns raw cells.
    """

    def code(t: Column) -> Column:
        turn = text_of(t["turn"])
        stream = F.struct(F.lit("stream").alias("output_type"), F.array(F.lit("out "), turn).alias("text"))
        result = F.struct(
            F.lit("").alias("text"),
            F.struct(F.concat(F.lit(" repr "), turn).alias("text/plain"), F.lit("iVBO").alias("image/png")).alias("data"),
        )
        error = F.struct(F.lit("error").alias("output_type"), F.lit("E").alias("ename"))
        return F.concat(
            F.lit('{"cell_type":"code","source":'),
            F.to_json(F.array(t["text"], F.lit("\n# turn "), turn)),
            F.lit(',"outputs":['),
            F.concat_ws(",", F.to_json(stream), F.to_json(result), F.to_json(error)),
            F.lit("]}"),
        )

    def cell(t: Column) -> Column:
        kind = F.when(t["role"] == "user", "markdown").otherwise("raw")
        text = F.to_json(F.struct(kind.alias("cell_type"), t["text"].alias("source")))
        return F.when(t["role"] == "assistant", code(t)).otherwise(text)

    parts = _conversation_parts(spark, sf_dir).select(
        "name",
        F.exists("turns", lambda t: t["role"] == "system").alias("cut"),
        F.concat(
            F.lit('{"nbformat":4,"cells":['), F.array_join(F.transform("turns", cell), ","), F.lit("]}")
        ).alias("json"),
    )
    copies = F.when(
        F.col("cut"),
        F.array(
            F.struct(F.lit("").alias("suffix"), F.col("json")),
            F.struct(F.lit("_cut").alias("suffix"), F.left("json", F.length("json") - 1).alias("json")),
        ),
    ).otherwise(F.array(F.struct(F.lit("").alias("suffix"), F.col("json"))))
    rows = parts.select("name", F.inline(copies))
    path = F.concat(F.lit("nb/"), F.col("name"), F.col("suffix"), F.lit(".ipynb"))
    return files_from_table(rows, path, F.col("json"))


def _grouped(rows: DataFrame, key: str, per_file: int, *fields: str) -> DataFrame:
    """k and the ordered rows of every run of ``per_file`` neighbouring keys."""
    return rows.groupBy(F.floor(F.col(key) / per_file).alias("k")).agg(
        F.sort_array(F.collect_list(F.struct(key, *fields))).alias("rows")
    )


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as comma-separated files with quoted multi-line text."""

    def line(r: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(r["text"], F.lit('"'), F.lit('""')), F.lit('"'))
        return F.concat_ws(",", text_of(r["doc_id"]), r["source"], quoted)

    groups = _grouped(table(spark, sf_dir, "documents"), "doc_id", DOCS_PER_CSV, "source", "text")
    body = F.concat(
        F.lit("\r\ndoc_id,source,text\r\n"), F.array_join(F.transform("rows", line), "\r\n"), F.lit("\r\n")
    )
    return files_from_table(groups, F.concat(F.lit("csv/docs_"), text_of(F.col("k")), F.lit(".csv")), body)


def tsv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    def line(r: Column) -> Column:
        return F.concat_ws("\t", text_of(r["o_orderkey"]), r["o_orderstatus"], F.lit(""), r["o_orderpriority"])

    groups = _grouped(
        table(spark, sf_dir, "orders"), "o_orderkey", ORDERS_PER_TSV, "o_orderstatus", "o_orderpriority"
    )
    body = F.concat(F.lit("key\tstatus\tnone\tpriority\n"), F.array_join(F.transform("rows", line), "\n"))
    return files_from_table(groups, F.concat(F.lit("tsv/orders_"), text_of(F.col("k")), F.lit(".tsv")), body)


def archives(spark: SparkSession, sf_dir: str, container: str) -> DataFrame:
    """Stored archives of neighbouring documents, with a directory entry."""
    groups = _grouped(table(spark, sf_dir, "documents"), "doc_id", DOCS_PER_ARCHIVE, "text")
    entries = F.transform(
        "rows", lambda r: member(F.concat(F.lit("d/"), text_of(r["doc_id"]), F.lit(".txt")), r["text"])
    )
    content = packed(F.concat(F.array(member("d/", "")), entries), container)
    path = F.concat(F.lit("arc/docs_"), text_of(F.col("k")), F.lit(f".{container}"))
    return files_from_table(groups, path, content)


def decks(spark: SparkSession, sf_dir: str, suffix: str = "pptx") -> DataFrame:
    """One deck per conversation part: a slide per turn, notes for all but assistant turns."""

    def runs(text: Column) -> Column:
        lines = F.transform(F.split(xml_escape(text), "\n"), lambda s: F.concat(F.lit("<a:r><a:t>"), s, F.lit("</a:t></a:r>")))
        return F.concat(F.lit("<p:sld><a:p>"), F.array_join(lines, ""), F.lit("</a:p></p:sld>"))

    def slide(t: Column) -> Column:
        n = text_of(t["turn"] + 1)
        return member(F.concat(F.lit("ppt/slides/slide"), n, F.lit(".xml")), runs(t["text"]))

    def notes(t: Column) -> Column:
        n = text_of(t["turn"] + 1)
        text = F.concat(F.lit("note by "), t["role"])
        return member(F.concat(F.lit("ppt/notesSlides/notesSlide"), n, F.lit(".xml")), runs(text))

    parts = _conversation_parts(spark, sf_dir)
    noted = F.filter("turns", lambda t: t["role"] != "assistant")
    content = packed(
        F.concat(
            F.array(member("[Content_Types].xml", "<Types/>")), F.transform("turns", slide), F.transform(noted, notes)
        )
    )
    return files_from_table(parts, F.concat(F.lit("deck/"), F.col("name"), F.lit(f".{suffix}")), content)


def word_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One word document per conversation part: a paragraph per turn and a table of turns and roles."""

    def paragraph(text: Column) -> Column:
        return F.concat(
            F.lit('<w:p><w:pPr><w:tabs><w:tab w:val="left"/></w:tabs></w:pPr><w:r><w:t xml:space="preserve">'),
            xml_escape(text),
            F.lit("</w:t></w:r></w:p>"),
        )

    def row(a: Column, b: Column, marks: str = "") -> Column:
        cells = [F.concat(F.lit("<w:tc>"), paragraph(x), F.lit("</w:tc>")) for x in (a, b)]
        return F.concat(F.lit(f"<w:tr>{marks}"), *cells, F.lit("</w:tr>"))

    parts = _conversation_parts(spark, sf_dir)
    xml = F.concat(
        F.lit("<w:document><w:body>"),
        F.array_join(F.transform("turns", lambda t: paragraph(t["text"])), ""),
        F.lit("<w:tbl><w:tblPr/>"),
        row(F.lit("turn"), F.lit("role & more"), "<w:trPr><w:tblHeader/></w:trPr>"),
        F.array_join(F.transform("turns", lambda t: row(text_of(t["turn"]), t["role"])), ""),
        F.lit("</w:tbl></w:body></w:document>"),
    )
    content = packed(F.array(member("word/document.xml", xml)))
    return files_from_table(parts, F.concat(F.lit("word/"), F.col("name"), F.lit(".docx")), content)


def ebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _grouped(table(spark, sf_dir, "pages"), "page_id", PAGES_PER_BOOK, "html")
    chapters = F.transform(
        "rows",
        lambda r: member(
            F.concat(F.lit("OEBPS/"), F.lpad(text_of(r["page_id"]), 12, "0"), F.lit(".xhtml")), r["html"]
        ),
    )
    content = packed(F.concat(F.array(member("mimetype", "application/epub+zip")), chapters))
    return files_from_table(groups, F.concat(F.lit("books/book_"), text_of(F.col("k")), F.lit(".epub")), content)


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks of customers: shared strings, inline strings, numbers, booleans and holes."""

    def ref(col: str, row: Column) -> Column:
        return F.concat(F.lit(f'<c r="{col}'), text_of(row), F.lit('"'))

    def inline(col: str, text: str) -> str:
        return f'<c r="{col}1" t="inlineStr"><is><t>{text}</t></is></c>'

    def number(col: str, row: Column, value: Column) -> Column:
        return F.concat(ref(col, row), F.lit("><v>"), text_of(value), F.lit("</v></c>"))

    def shared(col: str, row: Column, index: Column) -> Column:
        return F.concat(ref(col, row), F.lit(' t="s"><v>'), text_of(index), F.lit("</v></c>"))

    def sheet(header: str, line) -> Column:
        def row(r: Column, i: Column) -> Column:
            n = i + 2
            return F.concat(F.lit('<row r="'), text_of(n), F.lit('">'), line(r, i, n), F.lit("</row>"))

        return F.concat(
            F.lit(f'<worksheet><dimension ref="A1"/><sheetData><row r="1">{header}</row>'),
            F.array_join(F.transform("rows", row), ""),
            F.lit("</sheetData></worksheet>"),
        )

    def customer(r, i, n):
        return F.concat(number("A", n, r["c_custkey"]), shared("B", n, i * 2), shared("D", n, i * 2 + 1))

    def balance(r, i, n):
        owed = F.when(r["c_acctbal"] > 0, number("B", n, r["c_acctbal"])).otherwise(F.concat(ref("B", n), F.lit("/>")))
        rich = F.concat(ref("C", n), F.lit(' t="b"><v>'), text_of((r["c_acctbal"] > 5000).cast("int")), F.lit("</v></c>"))
        return F.concat(number("A", n, r["c_custkey"]), owed, rich)

    groups = _grouped(
        table(spark, sf_dir, "customer"), "c_custkey", CUSTOMERS_PER_BOOK, "c_name", "c_mktsegment", "c_acctbal"
    )
    strings = F.flatten(
        F.transform(
            "rows",
            lambda r: F.array(
                F.concat(F.lit("<si><r><t>"), F.left(r["c_name"], F.lit(8)), F.lit("</t></r><r><t>"), F.substring(r["c_name"], 9, 99), F.lit("</t></r></si>")),
                F.concat(F.lit("<si><t>"), r["c_mktsegment"], F.lit(" &amp; co</t></si>")),
            ),
        )
    )
    names = ["Customers", "Balances"]
    listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{9 - i}"/>' for i, n in enumerate(names, 1))
    related = "".join(
        f'<Relationship Id="rId{9 - i}" Type="worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in enumerate(names, 1)
    )
    content = packed(
        F.array(
            member("xl/workbook.xml", f"<workbook><sheets>{listed}</sheets></workbook>"),
            member("xl/_rels/workbook.xml.rels", f"<Relationships>{related}</Relationships>"),
            member("xl/sharedStrings.xml", F.concat(F.lit("<sst>"), F.array_join(strings, ""), F.lit("</sst>"))),
            member("xl/worksheets/sheet2.xml", sheet(inline("A", "key") + inline("B", "balance") + inline("C", "rich"), balance)),
            member("xl/worksheets/sheet1.xml", sheet(inline("A", "key") + inline("B", "name") + inline("D", "segment"), customer)),
        )
    )
    return files_from_table(groups, F.concat(F.lit("books/cust_"), text_of(F.col("k")), F.lit(".xlsx")), content)


def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, page_no, text, info: a page per turn."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        F.concat(F.lit("pdf/conv_"), text_of(F.col("conv_id")), F.lit(".pdf")).alias("path"),
        F.col("turn").alias("page_no"),
        F.concat(F.lit("\n\n"), F.col("text")).alias("text"),
        F.create_map(
            F.lit("Title"), F.concat(F.lit("Conversation "), text_of(F.col("conv_id"))), F.lit("CreationDate"), F.lit("D:20240101")
        ).alias("info"),
    )


# Leading bytes and suffixes of the byte corpus, near misses included.
HEADS = [b"%PDF", b"PK\x03\x04", b"Rar!", b"\x1f\x8b", b"\x89PNG", b"\xff\xd8\xff", b"RIFF", b"GIF8", b"BM", b"PK\x05\x06", b"\xff\xd8", b"\x00\x00\x00\x00", b""]
BYTE_SUFFIXES = [".pdf", ".docx", ".xlsx", ".pptx", ".epub", ".zip", ".JPG", ".htm", ".py", ".mobi", ".", "", ".7z", ".tar.gz", ".tiff", ".xls", ".Log"]


def bytes_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document behind some leading bytes and under some suffix."""
    rows = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("raw/doc_"), text_of(F.col("doc_id")), pick(BYTE_SUFFIXES, F.floor(F.col("doc_id") / len(HEADS))))
    content = F.concat(pick(HEADS, F.col("doc_id")), F.col("text").cast("binary"))
    return files_from_table(rows, path, content)


def _variants(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """Each document as itself and under other names: unreadable, empty, unknown, dot-less, listed only."""
    name, text = text_of(F.col("doc_id")), F.col("text").cast("binary")
    forms = {
        "doc": (F.concat(F.lit("corpus/doc_"), name, F.lit("."), pick(SUFFIXES, F.col("doc_id"))), text),
        "bad": (F.concat(F.lit("bad/deck_"), name, F.lit(".pptx")), text),
        "empty": (F.concat(F.lit("bad/empty_"), name, F.lit(".md")), F.lit(b"")),
        "unknown": (F.concat(F.lit("bad/code_"), name, F.lit(".py")), text),
        "plain": (F.concat(F.lit("bad/plain_"), name), text),
        "listed": (F.concat(F.lit("bad/old_"), name, F.lit(".rar")), text),
    }
    files = F.array(*[F.struct(forms[n][0].alias("p"), forms[n][1].alias("c")) for n in names])
    rows = table(spark, sf_dir, "documents").select(F.inline(files))
    return files_from_table(rows, F.col("p"), F.col("c"))


def mixed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text formats, pages, and empty, unreadable and unknown files."""
    return _variants(spark, sf_dir, ["doc", "bad", "empty", "unknown"]).unionByName(pages(spark, sf_dir))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All formats in one corpus, with empty, unreadable, unknown and dot-less files."""
    out = _variants(spark, sf_dir, ["doc", "bad", "empty", "unknown", "plain", "listed"])
    for more in [
        pages(spark, sf_dir),
        notebooks(spark, sf_dir),
        csv_files(spark, sf_dir),
        archives(spark, sf_dir, "zip"),
        decks(spark, sf_dir),
        ebooks(spark, sf_dir),
    ]:
        out = out.unionByName(more)
    return out
