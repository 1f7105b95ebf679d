"""Every operator as a query over the given tables, with its SQL check where SQL can state it.

A query returns scalar columns only; arrays are joined, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpora import build as B
from corpora import expected as X
from corpora import sql as S
from leafmill.functions import archive, delimited, detect, html, office, report, text
from leafmill.operators import long_tables as L
from leafmill.operators import routes as R
from leafmill.operators.paged import assemble_pages
from leafmill.operators.sinks import export_reports, render_report
from leafmill.operators.summary import summarise
from leafmill.options import ParseOptions
from leafmill.plans import corpus
from leafmill.sources.files import files_from_table, scan_files
from leafmill.sources.members import explode_members

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

c = F.col
BAR = "\x1f"
BAR_SQL = "chr(31)"


def query(check: str | None = None):
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if check is not None:
            CHECKS[fn.__name__] = check
        return fn

    return register


def big(x: Column) -> Column:
    return x.cast("bigint")


def joined(x: Column) -> Column:
    return F.array_join(x, BAR)


def raw() -> Column:
    return text.decode_text(c("content"))


def dirty() -> Column:
    return F.concat(F.lit(" "), F.replace(c("text"), F.lit(". "), F.lit(".\t \r\n\r\n\r\n")))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return B.table(spark, d, "documents")


def dirty_files(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("md/doc_"), c("doc_id").cast("string"), F.lit(".md"))
    return files_from_table(documents(spark, d), path, dirty())


# --- scans, sources, routing -------------------------------------------------------------------


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


# Larger files are read by several tasks.
SPLIT_ABOVE = 64 << 20


@query(
    "SELECT * FROM (VALUES " + ", ".join(f"('{t}', '50415231', true)" for t in _TABLES) + ") AS t(table_name, magic, whole)"
)
def corpus_scan(spark, d):
    """The bytes of the files of the data directory: per table the leading bytes, and whether all content was read."""
    files = scan_files(spark, d, "*.parquet", split_above=SPLIT_ABOVE)
    # A line may be shorter than the leading bytes, so the first four count: the least numbers of each remainder.
    head = F.when(c("start") == 0, F.struct(c("n"), F.hex(F.substring("content", 1, 4)).alias("bytes")))
    firsts = [F.min(F.when(c("n") % 4 == k, head)).alias(f"first{k}") for k in range(4)]
    per_file = (
        files.withColumn("n", F.monotonically_increasing_id())
        .groupBy("path", "file_size")
        .agg(F.sum(F.octet_length("content")).alias("read"), *firsts)
    )
    lines = F.array_sort(F.array_compact(F.array(*[f"first{k}" for k in range(4)])))
    split_end = F.when(c("file_size") > SPLIT_ABOVE, 1).otherwise(0)  # the line end that the last line may lack
    return (
        per_file.select(
            F.regexp_extract("path", r"/(\w+)\.parquet(?:/|$)", 1).alias("table_name"),
            F.nullif(F.left(F.array_join(F.transform(lines, lambda f: f["bytes"]), ""), F.lit(8)), F.lit("")).alias("magic"),
            c("read").between(c("file_size"), c("file_size") + split_end).alias("read"),
        )
        .groupBy("table_name", "magic")
        .agg(F.bool_and("read").alias("whole"))
    )


_PATH_SQL = (
    "CASE WHEN lang = 'en' THEN '/data/' || lang || '/' || source || '\\doc_' || doc_id || '.txt' "
    "ELSE '/data/' || lang || '/doc_' || doc_id || '.txt' END"
)


@query(f"SELECT {_PATH_SQL} AS path, 'doc_' || doc_id || '.txt' AS file_name FROM documents")
def file_name(spark, d):
    name = F.concat(F.lit("doc_"), c("doc_id").cast("string"), F.lit(".txt"))
    path = F.when(c("lang") == "en", F.concat(F.lit("/data/"), "lang", F.lit("/"), "source", F.lit("\\"), name)).otherwise(
        F.concat(F.lit("/data/"), "lang", F.lit("/"), name)
    )
    return documents(spark, d).select(path.alias("path")).select("path", detect.file_name(c("path")).alias("file_name"))


@query(
    "SELECT 'corpus/doc_' || doc_id || '.txt' AS path, 'doc_' || doc_id || '.txt' AS file_name, 0::BIGINT AS file_size, 'error' AS type, "
    "'Failed to read file: ENOENT: no such file or directory, open ''corpus/doc_' || doc_id || '.txt''' AS text, 0::BIGINT AS total_chars "
    "FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
)
def read_failures(spark, d):
    """Labelled documents were delivered; the manifest asks for all."""
    path = F.concat(F.lit("corpus/doc_"), c("doc_id").cast("string"), F.lit(".txt"))
    manifest = documents(spark, d).select(path.alias("path"))
    delivered = B.table(spark, d, "labels").select(path.alias("path"))
    return R.read_failures(manifest, delivered).select("path", "file_name", "file_size", "type", "text", "total_chars")


@query(
    "SELECT 'doc_' || doc_id || '.md' AS file_name, 0::BIGINT AS file_size, 'empty' AS type, 'File is empty.' AS text, 0::BIGINT AS total_chars "
    "FROM documents WHERE source = 'src7'"
)
def empty_files(spark, d):
    path = F.concat(F.lit("md/doc_"), c("doc_id").cast("string"), F.lit(".md"))
    body = F.when(c("source") == "src7", "").otherwise(c("text"))
    files = files_from_table(documents(spark, d), path, body)
    return R.empty_files(files).select("file_name", "file_size", "type", "text", "total_chars")


_ALL_SUFFIXES = [*X.EXTENSION_TYPES, "py", "tif", "MD", "Tar"]
_SUFFIX_SQL = S.pick(_ALL_SUFFIXES, "doc_id")


@query(
    f"SELECT file_name, ext, {S.ext_type('ext')} AS type FROM (SELECT file_name, {S.extension('file_name')} AS ext "
    f"FROM (SELECT 'doc.v1_' || doc_id || '.' || {_SUFFIX_SQL} AS file_name FROM documents))"
)
def extension_type(spark, d):
    name = F.concat(F.lit("doc.v1_"), c("doc_id").cast("string"), F.lit("."), B.pick(_ALL_SUFFIXES, c("doc_id")))
    named = documents(spark, d).select(name.alias("file_name")).withColumn("ext", detect.extension(c("file_name")))
    return named.withColumn("type", detect.ext_type(c("ext")))


@query(f"SELECT file_name, {S.magic('hexed')} AS magic FROM ({S.BYTES})")
def magic_type(spark, d):
    return B.bytes_files(spark, d).select("file_name", detect.magic_type(c("content")).alias("magic"))


@query(
    f"SELECT file_name, CASE WHEN magic = 'zip' AND list_contains({S.ZIPS}, ext) THEN ext ELSE magic END AS refined FROM "
    f"(SELECT file_name, {S.magic('hexed')} AS magic, {S.extension('file_name')} AS ext FROM ({S.BYTES}))"
)
def zip_refine(spark, d):
    refined = detect.zip_refine(detect.magic_type(c("content")), detect.extension(c("file_name")))
    return B.bytes_files(spark, d).select("file_name", refined.alias("refined"))


@query(f"SELECT doc_id, {S.is_text('hexed')} AS is_text FROM (SELECT doc_id, hex(encode(translate(text, 'ean', chr(1) || chr(2) || chr(3)))) AS hexed FROM documents)")
def text_sniff(spark, d):
    """Three frequent letters become control bytes, which puts documents on both sides of the limit."""
    noisy = F.translate("text", "ean", "\x01\x02\x03").cast("binary")
    return documents(spark, d).select("doc_id", detect.is_text(noisy).alias("is_text"))


@query(f"SELECT file_name, type, ext, confidence FROM ({S.DETECTED})")
def detect_type(spark, d):
    return corpus.detect(B.bytes_files(spark, d)).select("file_name", "type", "ext", "confidence")


_KNOWN = sorted(X.KNOWN_TYPES)
_UNKNOWN_TEXT = (
    "'Unrecognized file type: ' || type || ' (extension: ' || ext || ').' || chr(10) || 'File size: ' || file_size || ' bytes.' || chr(10) || "
    f"'{X.UNKNOWN_TAIL}'"
)


@query(
    f"SELECT file_name, 'unknown' AS type, CASE WHEN type <> 'unknown' THEN upper(type) END AS format, {_UNKNOWN_TEXT} AS text, 0::BIGINT AS total_chars "
    f"FROM ({S.DETECTED}) WHERE NOT list_contains({S.text_list(_KNOWN)}, type)"
)
def unknown_notice(spark, d):
    rows = R.unknowns(corpus.detect(B.bytes_files(spark, d)))
    return rows.select("file_name", "type", c("meta.format").alias("format"), "text", "total_chars")


def _sized(label: str, tail: str) -> str:
    return f"'{label} file: ' || file_name || ' (' || {S.size_label('file_size')} || '). {tail}'"


_NOTICE_CASES = " ".join(
    f"WHEN type = '{t}' THEN {_sized(X.NOTICE_LABELS[t], tail)}" for t, tail in X.NOTICE_TAILS.items()
)
_NOTICES = f"""
SELECT file_name, CASE WHEN list_contains({S.text_list(X.IMAGE_TYPES)}, type) THEN 'image' ELSE type END AS type,
  CASE type WHEN 'rar' THEN 'RAR' WHEN '7z' THEN '7z' WHEN 'gz' THEN 'GZip' WHEN 'mobi' THEN 'MOBI' WHEN 'pdf' THEN 'PDF'
    ELSE upper(regexp_extract(file_name, '[^.]*$')) END AS format,
  CASE {_NOTICE_CASES} WHEN type = 'mobi' THEN 'MOBI file: ' || file_name || '. {X.MOBI_TAIL}'
    WHEN type = 'pdf' THEN {_sized('PDF', X.PDF_TAIL)}
    ELSE 'Image file: ' || file_name || ' (' || printf('%.1f', round(file_size / 1024.0, 1)) || ' KB). {X.IMAGE_TAIL}' END AS text
FROM ({S.DETECTED}) WHERE list_contains({S.text_list(X.NOTICE_TYPES)}, type)
"""


@query(f"SELECT *, length(text) AS total_chars, {S.words('text')} AS words FROM ({_NOTICES})")
def format_notices(spark, d):
    rows = R.notices(corpus.detect(B.bytes_files(spark, d)))
    return rows.select(
        "file_name", "type", c("meta.format").alias("format"), "text", "total_chars", c("meta.word_count").alias("words")
    )


_BROKEN = ["pptx", "ppt", "docx", "xlsx", "xls", "epub", "tar"]


@query(
    f"SELECT 'doc_' || doc_id || '.' || {S.pick(_BROKEN, 'doc_id')} AS file_name, 'error' AS type, "
    f"'Error parsing ' || {S.pick(_BROKEN, 'doc_id')} || ' file: ' AS message_start, 0::BIGINT AS total_chars FROM documents"
)
def parse_errors(spark, d):
    """Text under the names of binary formats: every file becomes an error row."""
    rows = corpus.parse_corpus(B.docs(spark, d, _BROKEN))
    start = F.regexp_extract("text", "^Error parsing [a-z]+ file: ", 0)
    return rows.select("file_name", "type", start.alias("message_start"), "total_chars")


_DOC_TYPE = f"{S.ext_type(S.pick(B.SUFFIXES, 'doc_id'))}"
_TYPED_DOCS = f"""
SELECT file_name, type, total_chars, text, octets AS file_size FROM (
  SELECT {S.DOC_NAME} AS file_name, {_DOC_TYPE} AS type, {S.octets('text')} AS octets,
    CASE {_DOC_TYPE} WHEN 'markdown' THEN {S.clean('text')} WHEN 'xml' THEN {S.clean('text')} ELSE text END AS text,
    length(CASE {_DOC_TYPE} WHEN 'markdown' THEN {S.clean('text')} WHEN 'xml' THEN {S.clean('text')} ELSE text END) AS total_chars FROM documents)
"""
_INVALID_LENGTH = len(X.INVALID_NOTEBOOK)


@query(
    f"""
SELECT file_name, type, total_chars FROM ({_TYPED_DOCS})
UNION ALL SELECT file_name, 'html', length(full_text) FROM ({S.PAGES})
UNION ALL SELECT name || '.ipynb', 'ipynb', length(full_text) FROM ({S.notebooks()})
UNION ALL SELECT name || '_cut.ipynb', 'ipynb', {_INVALID_LENGTH} FROM ({S.notebooks()}) WHERE has_system
UNION ALL SELECT file_name, 'xlsx', length(full_text) FROM ({S.csv_sheets()})
UNION ALL SELECT file_name, 'zip', length(full_text) FROM ({S.listings('zip')})
UNION ALL SELECT name || '.pptx', 'pptx', length(full_text) FROM ({S.decks()})
UNION ALL SELECT 'book_' || k || '.epub', 'epub', length(full_text) FROM ({S.ebooks()})
UNION ALL SELECT 'deck_' || doc_id || '.pptx', 'error', 0 FROM documents
UNION ALL SELECT 'empty_' || doc_id || '.md', 'empty', 0 FROM documents
UNION ALL SELECT 'code_' || doc_id || '.py', 'unknown', 0 FROM documents
UNION ALL SELECT 'plain_' || doc_id, 'text', length(text) FROM documents
UNION ALL SELECT 'old_' || doc_id || '.rar', 'rar', length({_sized('RAR', X.NOTICE_TAILS['rar'])}) FROM
  (SELECT doc_id, 'old_' || doc_id || '.rar' AS file_name, {S.octets('text')} AS file_size FROM documents)
"""
)
def parse_corpus(spark, d):
    return corpus.parse_corpus(B.mixed(spark, d)).select("file_name", "type", "total_chars")


# --- text --------------------------------------------------------------------------------------


@query("SELECT doc_id, left(text, 5) || chr(65533) || substring(text, 6) || chr(65533) AS text FROM documents")
def decode_text(spark, d):
    """A byte order mark, a bad byte inside and a cut-off character at the end."""
    content = F.concat(
        F.lit(b"\xef\xbb\xbf"),
        F.left("text", F.lit(5)).cast("binary"),
        F.lit(b"\xff"),
        F.substring("text", 6, 100_000_000).cast("binary"),
        F.lit(b"\xe2\x82"),
    )
    return documents(spark, d).select("doc_id", text.decode_text(content).alias("text"))


@query(f"SELECT doc_id, {S.clean(S.DIRTY)} AS text FROM documents")
def clean_text(spark, d):
    return documents(spark, d).select("doc_id", text.clean_text(dirty()).alias("text"))


@query(f"SELECT doc_id, {S.words(S.DIRTY)} AS words FROM documents")
def word_count(spark, d):
    return documents(spark, d).select("doc_id", text.word_count(dirty()).alias("words"))


@query(
    f"SELECT *, length(text) AS returned_chars FROM ({S.limited('SELECT doc_id, text AS full_text FROM documents', 'doc_id', 1000)})"
)
def truncate_note(spark, d):
    return documents(spark, d).select("doc_id", text.truncate_note(c("text"), 1000).alias("t")).select("doc_id", "t.*")


@query(
    "SELECT doc_id, left(text, 1000) AS text, length(text) > 1000 AS truncated, length(text) AS total_chars, "
    "least(length(text), 1000) AS returned_chars FROM documents"
)
def truncate_plain(spark, d):
    return documents(spark, d).select("doc_id", text.truncate_plain(c("text"), 1000).alias("t")).select("doc_id", "t.*")


@query(f"SELECT doc_id, {S.size_label('(n_chars * n_chars)')} AS label FROM documents")
def size_label(spark, d):
    return documents(spark, d).select("doc_id", text.size_label(c("n_chars") * c("n_chars")).alias("label"))


@query("SELECT doc_id, format('{:,}', n_chars * n_chars) AS label FROM documents")
def int_label(spark, d):
    return documents(spark, d).select("doc_id", text.int_label(c("n_chars") * c("n_chars")).alias("label"))


_XML_SQL = "'<r a=\"1\">' || chr(10) || ' <t>' || replace(text, '. ', '.</t>' || chr(10) || ' ' || chr(9) || chr(10) || '<t>') || '</t>&amp;</r>'"
_STRIPPED = S.clean(
    f"regexp_replace(regexp_replace(regexp_replace({_XML_SQL}, '<[^>]+>', ' ', 'g'), '[ \\t]+', ' ', 'g'), '\\n\\s*\\n', chr(10), 'g')"
)


@query(f"SELECT file_name, 'XML' AS format, text, {S.words('text')} AS words FROM (SELECT 'doc_' || doc_id || '.xml' AS file_name, {_STRIPPED} AS text FROM documents)")
def xml_text(spark, d):
    body = F.concat(
        F.lit('<r a="1">\n <t>'), F.replace(c("text"), F.lit(". "), F.lit(".</t>\n \t\n<t>")), F.lit("</t>&amp;</r>")
    )
    path = F.concat(F.lit("xml/doc_"), c("doc_id").cast("string"), F.lit(".xml"))
    rows = R.xml_documents(files_from_table(documents(spark, d), path, body))
    return rows.select("file_name", c("meta.format").alias("format"), "text", c("meta.word_count").alias("words"))


@query(
    f"SELECT file_name, 'markdown' AS type, 'Markdown' AS format, text, length(text) AS total_chars, {S.words('text')} AS words FROM "
    f"(SELECT 'doc_' || doc_id || '.md' AS file_name, {S.clean(S.DIRTY)} AS text FROM documents)"
)
def markdown_docs(spark, d):
    rows = R.markdown_documents(dirty_files(spark, d))
    return rows.select(
        "file_name", "type", c("meta.format").alias("format"), "text", "total_chars", c("meta.word_count").alias("words")
    )


_PLAIN_SUFFIXES = ["txt", "json", "yaml", "yml", "toml", "ini", "cfg", "log"]
_PLAIN_SQL = S.pick(_PLAIN_SUFFIXES, "doc_id")


@query(
    f"SELECT 'doc_' || doc_id || '.' || {_PLAIN_SQL} AS file_name, {S.ext_type(_PLAIN_SQL)} AS type, upper({S.ext_type(_PLAIN_SQL)}) AS format, "
    f"left(text, 1000) AS text, length(text) > 1000 AS truncated, length(text) AS total_chars, least(length(text), 1000) AS returned_chars, "
    f"{S.words('text')} AS words FROM documents"
)
def plain_docs(spark, d):
    rows = R.plain_documents(B.docs(spark, d, _PLAIN_SUFFIXES), ParseOptions(max_chars=1000))
    return rows.select(
        "file_name", "type", c("meta.format").alias("format"), "text", "truncated", "total_chars", "returned_chars",
        c("meta.word_count").alias("words"),
    )


_CLEANED = f"SELECT 'doc_' || doc_id || '.md' AS file_name, {S.clean(S.DIRTY)} AS full_text FROM documents"


@query(
    f"SELECT *, length(text) AS returned_chars, {S.words('text')} AS words FROM ({S.limited(_CLEANED, 'file_name', 1000)})"
)
def result_envelope(spark, d):
    rows = R.markdown_documents(dirty_files(spark, d), ParseOptions(max_chars=1000))
    return rows.select(
        "file_name", "text", "truncated", "total_chars", "returned_chars", c("meta.word_count").alias("words")
    )


# --- web pages ---------------------------------------------------------------------------------


@query(f"SELECT file_name, title FROM ({S.PAGES})")
def page_titles(spark, d):
    return B.pages(spark, d).select("file_name", html.title(html.visible_html(raw())).alias("title"))


@query(
    "SELECT file_name, pos, h.level AS level, h.heading AS heading FROM "
    f"(SELECT file_name, unnest(range(0, len(outline))) AS pos, unnest(outline) AS h FROM ({S.PAGES}))"
)
def page_headings(spark, d):
    return L.headings(B.pages(spark, d)).select(
        detect.file_name(c("path")).alias("file_name"), big(c("pos")).alias("pos"), big(c("level")).alias("level"), "heading"
    )


@query(f"SELECT file_name, unnest(range(0, len(blocks))) AS pos, unnest(blocks) AS text FROM ({S.PAGES})")
def page_blocks(spark, d):
    return L.blocks(B.pages(spark, d)).select(
        detect.file_name(c("path")).alias("file_name"), big(c("pos")).alias("pos"), "text"
    )


@query(
    f"SELECT file_name, title, 'HTML' AS format, full_text AS text, length(full_text) AS total_chars, {S.words('full_text')} AS words, "
    f"len(outline) AS headings FROM ({S.PAGES})"
)
def page_documents(spark, d):
    rows = R.html_documents(B.pages(spark, d))
    return rows.select(
        "file_name", c("meta.title").alias("title"), c("meta.format").alias("format"), "text", "total_chars",
        c("meta.word_count").alias("words"), big(F.size("structure")).alias("headings"),
    )


# --- notebooks ---------------------------------------------------------------------------------


@query(
    f"SELECT name || '_cut.ipynb' AS file_name, 'ipynb' AS type, 'IPYNB' AS format, '{X.INVALID_NOTEBOOK}' AS text FROM ({S.notebooks()}) WHERE has_system"
)
def notebook_invalid(spark, d):
    rows = R.notebook_documents(B.notebooks(spark, d)).filter(c("meta.format") == "IPYNB")
    return rows.select("file_name", "type", c("meta.format").alias("format"), "text")


def _cells(spark, d):
    return L.cells(B.notebooks(spark, d)).select(
        detect.file_name(c("path")).alias("file_name"), big(c("pos")).alias("pos"), "cell_type", "source", "outputs"
    )


_OUTS = "CASE WHEN cell_type = 'code' THEN ['out ' || turn, 'repr ' || turn] ELSE [] END"


@query(
    f"SELECT name || '.ipynb' AS file_name, pos, cell_type, len({_OUTS}) AS outputs FROM ({S.CELLS})"
)
def notebook_cells(spark, d):
    return _cells(spark, d).select("file_name", "pos", "cell_type", big(F.size("outputs")).alias("outputs"))


@query(f"SELECT name || '.ipynb' AS file_name, pos, source FROM ({S.CELLS})")
def notebook_sources(spark, d):
    return _cells(spark, d).select("file_name", "pos", "source")


@query(
    f"SELECT name || '.ipynb' AS file_name, pos, unnest([0, 1])::BIGINT AS nth, unnest({_OUTS}) AS output FROM ({S.CELLS}) WHERE cell_type = 'code'"
)
def notebook_outputs(spark, d):
    rows = _cells(spark, d).select("file_name", "pos", F.posexplode("outputs").alias("nth", "output"))
    return rows.withColumn("nth", big(c("nth")))


@query(f"SELECT name || '.ipynb' AS file_name, full_text AS text FROM ({S.notebooks(2)})")
def notebook_limit(spark, d):
    rows = R.notebook_documents(B.notebooks(spark, d), ParseOptions(max_pages=2))
    return rows.filter(c("meta.format") != "IPYNB").select("file_name", "text")


@query(
    f"SELECT name || '.ipynb' AS file_name, 'ipynb' AS type, 'Jupyter Notebook' AS format, full_text AS text, length(full_text) AS total_chars, "
    f"{S.words('full_text')} AS words FROM ({S.notebooks()})"
)
def notebook_documents(spark, d):
    rows = R.notebook_documents(B.notebooks(spark, d)).filter(c("meta.format") != "IPYNB")
    return rows.select(
        "file_name", "type", c("meta.format").alias("format"), "text", "total_chars", c("meta.word_count").alias("words")
    )


# --- delimited text and workbooks --------------------------------------------------------------


@query(
    f"SELECT 'docs_' || k || '.csv' AS file_name, row_pos::BIGINT AS row_pos, len(cells) AS n, array_to_string(cells, {BAR_SQL}) AS cells FROM ({S.CSV_ROWS})"
)
def delimited_rows(spark, d):
    rows = L.delimited_rows(B.csv_files(spark, d))
    return rows.select(
        detect.file_name(c("path")).alias("file_name"), big(c("row_pos")).alias("row_pos"), big(F.size("cells")).alias("n"),
        joined(c("cells")).alias("cells"),
    )


@query(
    f"SELECT 'docs_' || k || '.csv' AS file_name, 'doc_id' || {BAR_SQL} || 'source' || {BAR_SQL} || 'text' AS headers, count(*) - 1 AS n_rows, "
    "CAST(sum(CASE WHEN len(cells) = 3 AND cells[1] <> 'doc_id' THEN length(cells[3]) END) AS BIGINT) AS text_chars "
    f"FROM ({S.CSV_ROWS}) GROUP BY k"
)
def header_promotion(spark, d):
    rows = delimited.delimited_rows(raw(), ",")
    table = B.csv_files(spark, d).select("file_name", delimited.promote_header(rows, F.lit("Sheet1")).alias("t"))
    lengths = F.transform(c("t.rows"), lambda r: F.coalesce(F.length(F.get(r, F.lit(2))), F.lit(0)))
    total = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return table.select(
        "file_name", joined(c("t.headers")).alias("headers"), big(F.size("t.rows")).alias("n_rows"), total.alias("text_chars")
    )


@query(
    f"SELECT file_name, 'xlsx' AS type, format, 1::BIGINT AS sheets, full_text AS text FROM ({S.csv_sheets()} UNION ALL {S.tsv_sheets()})"
)
def sheet_documents(spark, d):
    opts = ParseOptions(max_chars=-1)
    rows = R.sheet_documents(B.csv_files(spark, d), ",", opts).unionByName(
        R.sheet_documents(B.tsv_files(spark, d), "\t", opts)
    )
    return rows.select(
        "file_name", "type", c("meta.format").alias("format"), big(c("meta.sheets")).alias("sheets"), "text"
    )


@query(
    f"SELECT 'cust_' || k || '.xlsx' AS file_name, sheet_pos::BIGINT AS sheet_pos, sheet_name, \"row\"::BIGINT AS \"row\", col::BIGINT AS col, value FROM ({S.BOOK_CELLS})"
)
def workbook_cells(spark, d):
    rows = L.workbook_cells(B.workbooks(spark, d))
    return rows.select(
        detect.file_name(c("path")).alias("file_name"), big(c("sheet_pos")).alias("sheet_pos"), "sheet_name",
        big(c("row")).alias("row"), big(c("col")).alias("col"), "value",
    )


@query(
    f"SELECT file_name, 2::BIGINT AS sheets, 1::BIGINT AS shown, full_text AS text FROM ({S.books(1)}) UNION ALL "
    f"SELECT file_name, 2, 2, full_text FROM ({S.books(2)})"
)
def sheet_limit(spark, d):
    """The first sheet with a note, and both sheets."""
    books = B.workbooks(spark, d)

    def job(limit):
        rows = R.container_documents(books, "xlsx", ParseOptions(max_pages=limit))
        return rows.select(
            "file_name", big(c("meta.sheets")).alias("sheets"), big(F.size("tables")).alias("shown"), "text"
        )

    return job(1).unionByName(job(None))


# --- archives ----------------------------------------------------------------------------------


@query(
    f"SELECT 'docs_' || k || '.zip' AS file_name, name, is_dir, usize::BIGINT AS usize, usize::BIGINT AS csize, text FROM ({S.MEMBERS})"
)
def container_members(spark, d):
    rows = explode_members(B.archives(spark, d, "zip"), "zip")
    return rows.select(
        detect.file_name(c("path")).alias("file_name"), "name", "is_dir", "usize", "csize", text.decode_text(c("data")).alias("text")
    )


def _listing(spark, d, kind, limit=None):
    rows = R.container_documents(B.archives(spark, d, kind), kind, ParseOptions(max_pages=limit))
    return rows.select(
        "file_name", "file_size", c("meta.format").alias("format"), big(c("meta.entries")).alias("entries"), "text",
        F.array_join("archive_contents", "|").alias("contents"),
    )


@query(f"SELECT file_name, file_size, 'ZIP' AS format, entries, full_text AS text, contents FROM ({S.listings('zip')})")
def zip_listing(spark, d):
    return _listing(spark, d, "zip")


@query(f"SELECT file_name, file_size, 'TAR' AS format, entries, full_text AS text, contents FROM ({S.listings('tar')})")
def tar_listing(spark, d):
    return _listing(spark, d, "tar")


@query(
    "SELECT o_orderkey, CASE WHEN c > 0 AND u > 0 THEN CAST(floor((1.0::DOUBLE - c / u) * 100 + 0.5) AS BIGINT) ELSE 0 END AS ratio FROM "
    "(SELECT o_orderkey, o_custkey % 500 AS u, o_orderkey % 300 AS c FROM orders)"
)
def compression_ratio(spark, d):
    sizes = B.table(spark, d, "orders").select(
        "o_orderkey", (c("o_custkey") % 500).alias("u"), (c("o_orderkey") % 300).alias("c")
    )
    return sizes.select("o_orderkey", archive.compression_ratio(c("u"), c("c")).alias("ratio"))


@query(f"SELECT file_name, file_size, 'ZIP' AS format, entries, full_text AS text, contents FROM ({S.listings('zip', 10)})")
def entry_limit(spark, d):
    return _listing(spark, d, "zip", 10)


# --- decks, word documents, e-books, paged text ------------------------------------------------


@query("SELECT conv_id, turn, array_to_string(list_filter(string_split(text, chr(10)), lambda s: s <> ''), ' ') AS text FROM conversations")
def slide_text(spark, d):
    turns = B.table(spark, d, "conversations")
    xml = F.concat(F.lit('<p:sld><a:t lang="x">'), F.replace("text", F.lit("\n"), F.lit("</a:t><a:br/><a:t>")), F.lit("</a:t></p:sld>"))
    return turns.select("conv_id", "turn", office.slide_text(xml).alias("text"))


@query(f"SELECT name || '.pptx' AS file_name, slides, full_text AS text, length(full_text) AS total_chars FROM ({S.decks(3)})")
def deck_documents(spark, d):
    rows = R.container_documents(B.decks(spark, d), "pptx", ParseOptions(max_pages=3))
    return rows.select("file_name", big(c("meta.slides")).alias("slides"), "text", "total_chars")


@query(
    f"SELECT {S.CONV_NAME} || '.pptx' AS file_name, turn + 1 AS slide, CASE WHEN role <> 'assistant' THEN 'note by ' || role END AS notes FROM conversations"
)
def speaker_notes(spark, d):
    return L.slides(B.decks(spark, d)).select(detect.file_name(c("path")).alias("file_name"), "slide", "notes")


@query(f"SELECT name || '.docx' AS file_name, 'DOCX' AS format, full_text AS text, {S.words('full_text')} AS words FROM ({S.WORDS})")
def word_text(spark, d):
    rows = R.container_documents(B.word_files(spark, d), "docx")
    return rows.select("file_name", c("meta.format").alias("format"), "text", c("meta.word_count").alias("words"))


_WORD_ROWS = f"""
SELECT {S.CONV_NAME} || '.docx' AS file_name, row_number() OVER (PARTITION BY conv_id, {S.PART} ORDER BY turn) AS row_pos, false AS is_header,
  turn || {BAR_SQL} || role AS cells FROM conversations
UNION ALL SELECT DISTINCT {S.CONV_NAME} || '.docx', 0, true, 'turn' || {BAR_SQL} || 'role & more' FROM conversations
"""


@query(f"SELECT file_name, 0::BIGINT AS table_pos, row_pos::BIGINT AS row_pos, is_header, cells FROM ({_WORD_ROWS})")
def word_tables(spark, d):
    return L.word_tables(B.word_files(spark, d)).select(
        detect.file_name(c("path")).alias("file_name"), big(c("table_pos")).alias("table_pos"), big(c("row_pos")).alias("row_pos"),
        "is_header", joined(c("cells")).alias("cells"),
    )


_RANKED_PAGES = (
    f"SELECT page_id, page_id // {B.PAGES_PER_BOOK} AS k, row_number() OVER (PARTITION BY page_id // {B.PAGES_PER_BOOK} ORDER BY page_id) - 1 AS pos, "
    f"count(*) OVER (PARTITION BY page_id // {B.PAGES_PER_BOOK}) AS chapters FROM pages"
)


@query(
    f"SELECT 'book_' || k || '.epub' AS file_name, pos, 'OEBPS/' || lpad(page_id::VARCHAR, 12, '0') || '.xhtml' AS name, chapters FROM ({_RANKED_PAGES}) WHERE pos < 4"
)
def epub_chapters(spark, d):
    rows = L.chapters(B.ebooks(spark, d), ParseOptions(max_pages=4))
    return rows.select(
        detect.file_name(c("path")).alias("file_name"), big(c("pos")).alias("pos"), "name", big(c("chapters")).alias("chapters")
    )


@query(
    f"SELECT 'book_' || k || '.epub' AS file_name, 'EPUB' AS format, chapters AS pages, outline, full_text AS text FROM ({S.ebooks(8)})"
)
def epub_documents(spark, d):
    rows = R.container_documents(B.ebooks(spark, d), "epub", ParseOptions(max_chars=-1, max_pages=8))
    return rows.select(
        "file_name", c("meta.format").alias("format"), big(c("meta.pages")).alias("pages"),
        big(F.size("structure")).alias("outline"), "text",
    )


@query(
    f"SELECT file_name, 3::BIGINT AS shown, title, created, pages, full_text AS text FROM ({S.paged(3)}) UNION ALL "
    f"SELECT file_name, 0, title, created, pages, full_text FROM ({S.paged(None)})"
)
def paged_documents(spark, d):
    """The first three pages, and all pages."""
    pages = B.paged(spark, d)

    def job(limit):
        rows = assemble_pages(pages, ParseOptions(max_pages=limit))
        return rows.select(
            "file_name", F.lit(limit).cast("bigint").alias("shown"), c("meta.title").alias("title"),
            c("meta.created").alias("created"), big(c("meta.pages")).alias("pages"), "text",
        )

    return job(3).unionByName(job(0))


# --- tables, reports, sinks --------------------------------------------------------------------

_TABLE_ROWS = f"""
SELECT k, CASE WHEN row_pos = 0 THEN 1 WHEN row_pos = 1 THEN 0 ELSE row_pos END AS row_pos, row_pos = 1 AS is_header, cells FROM ({S.CSV_ROWS})
"""


@query(
    f"SELECT 'docs_' || k || '.csv' AS file_name, 'Sheet1' AS table_name, row_pos::BIGINT AS row_pos, is_header, array_to_string(cells, {BAR_SQL}) AS cells FROM ({_TABLE_ROWS})"
)
def table_rows(spark, d):
    rows = L.table_rows(R.sheet_documents(B.csv_files(spark, d)))
    return rows.select(
        detect.file_name(c("path")).alias("file_name"), "table_name", big(c("row_pos")).alias("row_pos"), "is_header",
        joined(c("cells")).alias("cells"),
    )


_MD_ROW = "'| ' || array_to_string(cells, ' | ') || ' |'"
_TSV_MD = f"""
SELECT file_name, '### Tables (1)' || chr(10) || chr(10) || '**Sheet1:**' || chr(10) || '| key | status | none | priority |' || chr(10) ||
  '| --- | --- | --- | --- |' || chr(10) || string_agg(line, chr(10) ORDER BY o_orderkey) FILTER (rank <= 20) ||
  (CASE WHEN count(*) > 20 THEN chr(10) || '| _... ' || (count(*) - 20) || ' more rows_ |' ELSE '' END) || chr(10) AS markdown
FROM (SELECT 'orders_' || (o_orderkey // {B.ORDERS_PER_TSV}) || '.tsv' AS file_name, o_orderkey,
        '| ' || o_orderkey || ' | ' || o_orderstatus || ' |  | ' || o_orderpriority || ' |' AS line,
        row_number() OVER (PARTITION BY o_orderkey // {B.ORDERS_PER_TSV} ORDER BY o_orderkey) AS rank FROM orders) GROUP BY file_name
"""


@query(_TSV_MD)
def markdown_tables(spark, d):
    rows = R.sheet_documents(B.tsv_files(spark, d), "\t")
    return rows.select("file_name", report.tables_md(c("tables")).alias("markdown"))


@query(f"SELECT '## ' || file_name || ' (HTML, ' || {S.size_label('file_size')} || ')' AS heading FROM ({S.PAGES})")
def report_heading(spark, d):
    rows = R.html_documents(B.pages(spark, d))
    return rows.select(report.report_heading(c("file_name"), c("type"), c("file_size")).alias("heading"))


@query(
    f"""
SELECT file_name, CASE WHEN title IS NULL THEN '' ELSE '- **Title**: ' || title || chr(10) END || '- **Format**: HTML' || chr(10) ||
  '- **Word Count**: ' || {S.words('full_text')} AS lines FROM ({S.PAGES})
UNION ALL SELECT 'book_' || k || '.epub', '- **Format**: EPUB' || chr(10) || '- **Pages**: ' || chapters || chr(10) || '- **Word Count**: ' ||
  {S.words('full_text')} FROM ({S.ebooks()})
UNION ALL SELECT file_name, '- **Format**: ZIP' || chr(10) || '- **Entries**: ' || entries || chr(10) || '- **Word Count**: ' ||
  {S.words('full_text')} FROM ({S.listings('zip')})
"""
)
def report_meta(spark, d):
    opts = ParseOptions(max_chars=-1)
    rows = (
        R.html_documents(B.pages(spark, d), opts)
        .unionByName(R.container_documents(B.ebooks(spark, d), "epub", opts))
        .unionByName(R.container_documents(B.archives(spark, d, "zip"), "zip", opts))
    )
    return rows.select("file_name", F.array_join(report.meta_lines(c("type"), c("meta")), "\n").alias("lines"))


@query(
    f"""
SELECT file_name, '- Words: ' || {S.words('full_text')} || ' | Chars: ' || format('{{:,}}', length(full_text)) AS line FROM ({S.PAGES})
UNION ALL SELECT 'book_' || k || '.epub', '- Words: ' || {S.words('full_text')} || ' | Chars: ' || format('{{:,}}', length(full_text)) || ' | Pages: ' || chapters
FROM ({S.ebooks()})
"""
)
def report_counts(spark, d):
    opts = ParseOptions(max_chars=-1)
    rows = R.html_documents(B.pages(spark, d), opts).unionByName(R.container_documents(B.ebooks(spark, d), "epub", opts))
    return rows.select("file_name", report.counts_line(c("meta"), c("text")).alias("line"))


@query(
    "SELECT file_name, CASE WHEN truncated THEN '> **Note:** Content was truncated (' || format('{:,}', length(text)) || ' of ' || "
    "format('{:,}', total_chars) || ' chars returned). Use maxChars for a higher limit.' END AS note "
    f"FROM ({S.limited(S.PAGES, 'file_name', 3000)})"
)
def report_truncation(spark, d):
    rows = R.html_documents(B.pages(spark, d), ParseOptions(max_chars=3000))
    note = report.truncation_line(c("truncated"), c("returned_chars"), c("total_chars"))
    return rows.select("file_name", note.alias("note"))


@query(
    "SELECT file_name, '### Archive Contents (' || entries || ' entries)' || chr(10) || chr(10) || "
    "array_to_string(list_transform(names[:50], lambda n: '- ' || n), chr(10)) || "
    "(CASE WHEN entries > 50 THEN chr(10) || '- _... ' || (entries - 50) || ' more entries_' ELSE '' END) || chr(10) AS section "
    f"FROM ({S.listings('zip')})"
)
def report_archive(spark, d):
    rows = R.container_documents(B.archives(spark, d, "zip"), "zip")
    return rows.select("file_name", F.array_join(report.archive_lines(c("archive_contents")), "\n").alias("section"))


_REPORT_ROWS = f"SELECT *, 'html' AS type, 'HTML' AS format FROM ({S.limited(S.PAGES, 'file_name, title, file_size', 3000)})"


@query(f"SELECT file_name, {S.report('r')} AS report FROM ({_REPORT_ROWS})")
def render_report_(spark, d):
    rows = R.html_documents(B.pages(spark, d), ParseOptions(max_chars=3000))
    return render_report(rows).select("file_name", "report")


@query(f"SELECT doc_id, 'doc.v_' || doc_id || '.md' AS name FROM documents")
def export_name(spark, d):
    name = F.concat(F.lit("doc.v_"), c("doc_id").cast("string"), F.lit("."), B.pick(B.SUFFIXES, c("doc_id")))
    return documents(spark, d).select("doc_id", report.export_name(name).alias("name"))


_FULL_ROWS = f"SELECT *, 'html' AS type, 'HTML' AS format, full_text AS text, false AS truncated, length(full_text) AS total_chars FROM ({S.PAGES})"


@query(f"SELECT 'page_' || page_id || '.md' AS export_name, {S.report('r')} AS report FROM ({_FULL_ROWS})")
def report_export(spark, d):
    """The table that the report sink writes: untruncated reports, whatever the limit."""
    return export_reports(B.pages(spark, d), ParseOptions(max_chars=10)).select("export_name", "report")


_SUMMARY_ROWS = f"""
SELECT type, file_size, total_chars, {S.words('text')} AS words FROM ({_TYPED_DOCS})
UNION ALL SELECT 'html', file_size, length(full_text), {S.words('full_text')} FROM ({S.PAGES})
UNION ALL SELECT 'error', {S.octets('text')}, 0, 0 FROM documents
UNION ALL SELECT 'empty', 0, 0, 0 FROM documents
UNION ALL SELECT 'unknown', {S.octets('text')}, 0, 0 FROM documents
"""


@query(
    "SELECT type, count(*) AS files, CAST(sum(file_size) AS BIGINT) AS bytes, CAST(sum(words) AS BIGINT) AS words, "
    "CAST(sum(total_chars) AS BIGINT) AS chars, 0::BIGINT AS truncated, CASE WHEN type = 'error' THEN count(*) ELSE 0 END AS failed "
    f"FROM ({_SUMMARY_ROWS}) GROUP BY type"
)
def corpus_summary(spark, d):
    return summarise(corpus.parse_corpus(B.mixed_text(spark, d), ParseOptions(max_chars=-1)))


QUERIES["render_report"] = QUERIES.pop("render_report_")
CHECKS["render_report"] = CHECKS.pop("render_report_")
