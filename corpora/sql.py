"""SQL fragments that the query checks share: the same results stated over the given tables."""

from __future__ import annotations

from corpora import build as B
from corpora.expected import EXTENSION_TYPES, SIGNATURES, WS, ZIP_BASED

WS_TEXT = "'" + WS + "'"
NL = "chr(10)"
SPACE = r"\x00-\x20\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"


def text_list(items) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


def pick(items, key: str) -> str:
    return f"{text_list(items)}[({key}) % {len(items)} + 1]"


def trim(x: str) -> str:
    return f"trim({x}, {WS_TEXT})"


def clean(x: str) -> str:
    x = f"replace(replace({x}, chr(13) || {NL}, {NL}), chr(13), {NL})"
    x = f"regexp_replace({x}, '\\t+', ' ', 'g')"
    x = f"regexp_replace({x}, '(?m)[ \\t]+$', '', 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', {NL} || {NL}, 'g')"
    return trim(x)


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{SPACE}]+'))"


def size_label(n: str) -> str:
    return (
        f"CASE WHEN {n} < 1024 THEN {n} || ' B' WHEN {n} < 1048576 THEN printf('%.1f KB', round({n} / 1024.0, 1)) "
        f"ELSE printf('%.1f MB', round({n} / 1048576.0, 1)) END"
    )


def octets(x: str) -> str:
    return f"octet_length(encode({x}))"


def limited(source: str, keys: str, limit: int) -> str:
    """keys, text, truncated, total_chars, returned_chars with the note; source has full_text."""
    note = (
        f"{NL} || {NL} || '[... truncated at {limit:,} chars. Total available: ' || "
        "format('{:,}', length(full_text)) || ' chars]'"
    )
    return (
        f"SELECT {keys}, CASE WHEN length(full_text) > {limit} THEN left(full_text, {limit}) || {note} "
        f"ELSE full_text END AS text, length(full_text) > {limit} AS truncated, length(full_text) AS total_chars "
        f"FROM ({source})"
    )


# --- detection ---------------------------------------------------------------------------------


def extension(name: str) -> str:
    return f"CASE WHEN contains({name}, '.') THEN lower(regexp_extract({name}, '[^.]*$')) ELSE '' END"


def ext_type(ext: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXTENSION_TYPES.items())
    return f"CASE {ext} {cases} ELSE {ext} END"


def magic(head: str) -> str:
    return "CASE " + " ".join(f"WHEN starts_with({head}, '{h}') THEN '{t}'" for h, t in SIGNATURES) + " END"


def is_text(hexed: str) -> str:
    """Over the hexadecimal form of the bytes."""
    pairs = f"regexp_extract_all(left({hexed}, 8192), '..')"
    good = "b IN ('09', '0A', '0D') OR (b >= '20' AND b <= '7E') OR (b >= '80' AND b <= 'F7')"
    return f"(len(list_filter({pairs}, lambda b: {good})) / len({pairs})) > 0.8"


HEADS_HEX = [h.hex().upper() for h in B.HEADS]

BYTES = (
    f"SELECT 'doc_' || doc_id || {pick(B.BYTE_SUFFIXES, f'doc_id // {len(B.HEADS)}')} AS file_name, "
    f"{pick(HEADS_HEX, 'doc_id')} || hex(encode(text)) AS hexed, length(hexed) // 2 AS file_size FROM documents"
)
ZIPS = text_list(ZIP_BASED)
DETECTED = f"""
SELECT file_name, hexed, file_size, CASE WHEN sure IS NOT NULL THEN sure WHEN mapped <> '' AND mapped <> 'zip' THEN mapped
       WHEN sniff THEN 'text' ELSE 'unknown' END AS type,
       CASE WHEN sure IS NOT NULL THEN sure WHEN mapped <> '' AND mapped <> 'zip' THEN ext
       WHEN sniff THEN 'txt' ELSE ext END AS ext,
       CASE WHEN sure IS NOT NULL THEN 'high' WHEN (mapped <> '' AND mapped <> 'zip') OR sniff THEN 'medium' ELSE 'low' END AS confidence
FROM (SELECT *, CASE WHEN magic = 'zip' AND list_contains({ZIPS}, ext) THEN ext ELSE magic END AS sure,
             {ext_type('ext')} AS mapped, {is_text('hexed')} AS sniff
      FROM (SELECT *, {extension('file_name')} AS ext, {magic('hexed')} AS magic FROM ({BYTES})))
"""

# --- text --------------------------------------------------------------------------------------

DIRTY = "(chr(160) || replace(text, '. ', '.' || chr(9) || ' ' || chr(13) || chr(10) || chr(13) || chr(10) || chr(13) || chr(10)))"
DOC_NAME = f"'doc_' || doc_id || '.' || {pick(B.SUFFIXES, 'doc_id')}"

# --- web pages ---------------------------------------------------------------------------------

_BLOCK = "p|li|blockquote|td|th|pre|code|dt|dd"
_OTHER = "html|head|body|title|nav|ul|ol|dl|div|article|section|aside|header|footer|main|table|thead|tbody|tr|form|figure|h[1-6]"


def entities(x: str) -> str:
    for a, b in [("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&nbsp;", "chr(160)"),
                 ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "'&'")]:
        x = f"replace({x}, '{a}', {b})"
    return x


def visible(x: str) -> str:
    return f"regexp_replace({x}, '(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<!--.*?-->', '', 'g')"


def inner(x: str) -> str:
    return trim(entities(f"regexp_replace({x}, '<[^>]+>', '', 'g')"))


def title(x: str) -> str:
    return f"nullif({inner(f'''regexp_extract({x}, '(?is)<title[^>]*>(.*?)</title>', 1)''')}, '')"


def blocks(x: str, block: str = _BLOCK, other: str = _OTHER) -> str:
    marked = f"regexp_replace({x}, '(?i)<({block})(\\s[^>]*)?>', chr(1), 'g')"
    marked = f"regexp_replace({marked}, '(?i)</?({block}|{other})(\\s[^>]*)?>', chr(2), 'g')"
    piece = inner("string_split(t, chr(2))[1]")
    return f"list_filter(list_transform(string_split({marked}, chr(1))[2:], lambda t: {piece}), lambda t: t <> '')"


def headings(x: str) -> str:
    """List of structs level, heading."""
    found = f"regexp_extract_all({x}, '(?is)<h[1-6](?:\\s[^>]*)?>.*?</h[1-6]>')"
    item = f"{{'level': CAST(h[3] AS BIGINT), 'heading': {inner('h')}}}"
    return f"list_filter(list_transform({found}, lambda h: {item}), lambda s: s.heading <> '')"


PAGES = f"""
SELECT page_id, 'page_' || page_id || '.html' AS file_name, {octets('html')} AS file_size, title, outline, blocks,
       {clean(f"(CASE WHEN title IS NULL THEN '' ELSE '# ' || title || {NL} || {NL} END) || array_to_string(blocks, {NL} || {NL})")} AS full_text
FROM (SELECT page_id, html, {title('v')} AS title, {headings('v')} AS outline, {blocks('v')} AS blocks
      FROM (SELECT page_id, html, {visible('html')} AS v FROM pages))
"""

# --- notebooks, decks, word documents, paged text ----------------------------------------------

PART = f"turn // {B.TURNS_PER_PART}"
CONV_NAME = f"'conv_' || conv_id || '_' || ({PART})"
_SOURCE = "CASE WHEN role = 'assistant' THEN text || chr(10) || '# turn ' || turn ELSE text END"
_KIND = "CASE role WHEN 'user' THEN 'markdown' WHEN 'assistant' THEN 'code' ELSE 'raw' END"
CELLS = f"""
SELECT {CONV_NAME} AS name, turn - ({PART}) * {B.TURNS_PER_PART} AS nth, turn, role, {_KIND} AS cell_type, {_SOURCE} AS source,
       row_number() OVER (PARTITION BY conv_id, {PART} ORDER BY turn) - 1 AS pos,
       count(*) OVER (PARTITION BY conv_id, {PART}) AS cells
FROM conversations
"""
_FENCE = "chr(96) || chr(96) || chr(96)"
CELL_TEXT = f"""CASE cell_type WHEN 'markdown' THEN {trim('source')} || {NL}
 WHEN 'code' THEN {_FENCE} || 'python' || {NL} || {trim('source')} || {NL} || {_FENCE} || {NL} || {_FENCE} || 'output' || {NL}
   || 'out ' || turn || {NL} || {_FENCE} || {NL} || {_FENCE} || 'output' || {NL} || 'repr ' || turn || {NL} || {_FENCE} || {NL} END"""


def notebooks(limit: int = 200) -> str:
    note = (
        f"CASE WHEN max(cells) > {limit} THEN {NL} || {NL} || '[... ' || (max(cells) - {limit}) || "
        "' more cell(s) not processed. Use maxPages to increase limit.]' ELSE '' END"
    )
    body = f"coalesce(string_agg({CELL_TEXT}, {NL} ORDER BY pos) FILTER (pos < {limit}), '') || {note}"
    return f"SELECT name, {clean(body)} AS full_text, bool_or(role = 'system') AS has_system FROM ({CELLS}) GROUP BY name"


def decks(limit: int = 100) -> str:
    lines = f"array_to_string(list_filter(string_split(text, {NL}), lambda s: s <> ''), ' ')"
    slide = f"'--- Slide ' || (turn + 1) || ' ---' || {NL} || {lines} || {NL}"
    note = "'[Speaker Notes - Slide ' || (turn + 1) || ']: note by ' || role"
    more = (
        f"CASE WHEN count(*) > {limit} THEN {NL} || {NL} || '[... ' || (count(*) - {limit}) || "
        "' more slide(s) not processed. Use maxPages to increase limit.]' ELSE '' END"
    )
    body = (
        f"string_agg({slide}, {NL} ORDER BY turn) FILTER (rank <= {limit}) || "
        f"coalesce({NL} || string_agg({note}, {NL} ORDER BY turn) FILTER (role <> 'assistant'), '') || {more}"
    )
    ranked = f"SELECT *, {CONV_NAME} AS name, row_number() OVER (PARTITION BY conv_id, {PART} ORDER BY turn) AS rank FROM conversations"
    return f"SELECT name, count(*) AS slides, {clean(body)} AS full_text FROM ({ranked}) GROUP BY name"


WORD_TEXT = clean(
    f"string_agg(text, {NL} || {NL} ORDER BY turn) || {NL} || {NL} || 'turn' || {NL} || {NL} || 'role & more' || {NL} || {NL} || "
    f"string_agg(turn || {NL} || {NL} || role, {NL} || {NL} ORDER BY turn)"
)
WORDS = f"SELECT {CONV_NAME} AS name, {WORD_TEXT} AS full_text FROM conversations GROUP BY conv_id, {PART}"


def paged(limit: int | None) -> str:
    keep = f"FILTER (rank <= {limit})" if limit else ""
    return f"""
SELECT 'conv_' || conv_id || '.pdf' AS file_name, 'Conversation ' || conv_id AS title, 'D:20240101' AS created,
       count(*) AS pages, {clean(f"string_agg({NL} || {NL} || text, '' ORDER BY turn) {keep}")} AS full_text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rank FROM conversations) GROUP BY conv_id
"""


def ebooks(limit: int = 50) -> str:
    """k, chapters, full_text, outline (count of entries)."""
    block = "p|li|blockquote|td|th"
    other = _OTHER + "|pre|dt|dd"
    chapter = (
        "list_concat(CASE WHEN title IS NULL THEN [] ELSE ['# ' || title] END, "
        "list_transform(outline, lambda h: repeat('#', h.level) || ' ' || h.heading), blocks)"
    )
    more = (
        f"CASE WHEN count(*) > {limit} THEN {NL} || {NL} || '[... ' || (count(*) - {limit}) || "
        "' more file(s) not processed. Use maxPages to increase limit.]' ELSE '' END"
    )
    body = f"string_agg(array_to_string({chapter}, {NL}), {NL} ORDER BY page_id) FILTER (rank <= {limit}) || {more}"
    entries = f"sum(len(outline) + (title IS NOT NULL)::BIGINT) FILTER (rank <= {limit})"
    return f"""
SELECT k, count(*) AS chapters, {clean(body)} AS full_text, CAST({entries} AS BIGINT) AS outline
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY page_id) AS rank FROM (
  SELECT page_id, page_id // {B.PAGES_PER_BOOK} AS k, {title('v')} AS title, {headings('v')} AS outline, {blocks('v', block, other)} AS blocks
  FROM (SELECT page_id, {visible('html')} AS v FROM pages))) GROUP BY k
"""


# --- sheets ------------------------------------------------------------------------------------

CSV_ROWS = f"""
SELECT doc_id // {B.DOCS_PER_CSV} AS k, row_number() OVER (PARTITION BY doc_id // {B.DOCS_PER_CSV} ORDER BY doc_id) + 1 AS row_pos,
       [CAST(doc_id AS VARCHAR), source, text] AS cells FROM documents
UNION ALL SELECT k, unnest([0, 1]), unnest([[], ['doc_id', 'source', 'text']]) FROM (SELECT DISTINCT doc_id // {B.DOCS_PER_CSV} AS k FROM documents)
"""


def csv_sheets() -> str:
    line = "array_to_string(cells, chr(9))"
    body = f"'=== Sheet: Sheet1 ===' || {NL} || string_agg({line}, {NL} ORDER BY row_pos)"
    return f"SELECT 'docs_' || k || '.csv' AS file_name, 'CSV' AS format, {clean(body)} AS full_text FROM ({CSV_ROWS}) GROUP BY k"


def tsv_sheets() -> str:
    line = "o_orderkey || chr(9) || o_orderstatus || chr(9) || chr(9) || o_orderpriority"
    head = "'key' || chr(9) || 'status' || chr(9) || 'none' || chr(9) || 'priority'"
    body = f"'=== Sheet: Sheet1 ===' || {NL} || {head} || {NL} || string_agg({line}, {NL} ORDER BY o_orderkey)"
    k = f"o_orderkey // {B.ORDERS_PER_TSV}"
    return f"SELECT 'orders_' || ({k}) || '.tsv' AS file_name, 'XLSX' AS format, {clean(body)} AS full_text FROM orders GROUP BY {k}"


_BOOK = f"c_custkey // {B.CUSTOMERS_PER_BOOK}"
_BALANCE = "regexp_replace(CAST(c_acctbal AS VARCHAR), '\\.0$', '')"
_RICH = "CASE WHEN c_acctbal > 5000 THEN 'true' ELSE 'false' END"
BOOK_CELLS = f"""
WITH c AS (SELECT *, {_BOOK} AS k, row_number() OVER (PARTITION BY {_BOOK} ORDER BY c_custkey) + 1 AS r FROM customer)
SELECT k, 0 AS sheet_pos, 'Customers' AS sheet_name, r AS "row", unnest([1, 2, 4]) AS col,
       unnest([CAST(c_custkey AS VARCHAR), c_name, c_mktsegment || ' & co']) AS value FROM c
UNION ALL SELECT k, 0, 'Customers', 1, unnest([1, 2, 4]), unnest(['key', 'name', 'segment']) FROM (SELECT DISTINCT k FROM c)
UNION ALL SELECT k, 1, 'Balances', 1, unnest([1, 2, 3]), unnest(['key', 'balance', 'rich']) FROM (SELECT DISTINCT k FROM c)
UNION ALL SELECT k, 1, 'Balances', r, 1, CAST(c_custkey AS VARCHAR) FROM c
UNION ALL SELECT k, 1, 'Balances', r, 2, {_BALANCE} FROM c WHERE c_acctbal > 0
UNION ALL SELECT k, 1, 'Balances', r, 3, {_RICH} FROM c
"""


def books(sheets: int) -> str:
    first = (
        f"'=== Sheet: Customers ===' || {NL} || 'key' || chr(9) || 'name' || chr(9) || chr(9) || 'segment' || {NL} || "
        f"string_agg(c_custkey || chr(9) || c_name || chr(9) || chr(9) || c_mktsegment || ' & co', {NL} ORDER BY c_custkey)"
    )
    second = (
        f"'=== Sheet: Balances ===' || {NL} || 'key' || chr(9) || 'balance' || chr(9) || 'rich' || {NL} || string_agg("
        f"c_custkey || chr(9) || (CASE WHEN c_acctbal > 0 THEN {_BALANCE} ELSE '' END) || chr(9) || {_RICH}, {NL} ORDER BY c_custkey)"
    )
    note = f"'[... 1 more sheet(s) not processed. Use maxPages to increase limit.]'"
    rest = second if sheets > 1 else note
    return f"SELECT 'cust_' || ({_BOOK}) || '.xlsx' AS file_name, {clean(f'{first} || {NL} || {NL} || {rest}')} AS full_text FROM customer GROUP BY {_BOOK}"


# --- archives ----------------------------------------------------------------------------------

_ARC = f"doc_id // {B.DOCS_PER_ARCHIVE}"
MEMBERS = f"""
SELECT {_ARC} AS k, 'd/' || doc_id || '.txt' AS name, false AS is_dir, {octets('text')} AS usize, text FROM documents
UNION ALL SELECT DISTINCT {_ARC}, 'd/', true, 0, NULL FROM documents
"""


def listings(kind: str, limit: int = 200) -> str:
    """k, file_name, file_size, entries, full_text, contents (names joined)."""
    if kind == "zip":
        size = "sum(30 + length(name) + usize + 46 + length(name)) + 22"
        line = f"'   ' || name || CASE WHEN is_dir THEN '/' ELSE ' (' || {size_label('usize')} || ', 0% compressed)' END"
    else:
        size = "ceil((sum(512 + ceil(usize / 512.0) * 512) + 1024) / 10240) * 10240"
        line = f"'  ' || name || ' (' || {size_label('usize')} || ')'"
    more = (
        f"CASE WHEN entries > {limit} THEN {NL} || {NL} || '[... ' || (entries - {limit}) || "
        "' more entries. Use maxPages to increase limit.]' ELSE '' END"
    )
    body = f"'Archive: ' || file_name || ' (' || {size_label('file_size')} || ')' || {NL} || entries || ' entries' || {NL} || {NL} || lines || {more}"
    return f"""
SELECT k, file_name, file_size, entries, contents, names, {clean(body)} AS full_text FROM (
  SELECT k, 'docs_' || k || '.{kind}' AS file_name, CAST({size} AS BIGINT) AS file_size, count(*) AS entries,
         string_agg(name, '|' ORDER BY name) AS contents, list(name ORDER BY name) AS names,
         string_agg({line}, {NL} ORDER BY name) FILTER (rank <= {limit}) AS lines
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY name) AS rank FROM ({MEMBERS})) GROUP BY k)
"""


# --- reports -----------------------------------------------------------------------------------


def report(source: str) -> str:
    """path-free report of rows with file_name, type, file_size, title, format, text, truncated, total_chars."""
    note = (
        "CASE WHEN truncated THEN '> **Note:** Content was truncated (' || format('{:,}', length(text)) || ' of ' || "
        f"format('{{:,}}', total_chars) || ' chars returned). Use maxChars for a higher limit.' || {NL} || {NL} ELSE '' END"
    )
    return (
        f"'## ' || file_name || ' (' || upper(type) || ', ' || {size_label('file_size')} || ')' || {NL} || {NL} || "
        f"(CASE WHEN title IS NULL THEN '' ELSE '- **Title**: ' || title || {NL} END) || '- **Format**: ' || format || {NL} || "
        f"'- **Word Count**: ' || {words('text')} || {NL} || {NL} || '- Words: ' || {words('text')} || ' | Chars: ' || "
        f"format('{{:,}}', length(text)) || {NL} || {NL} || {note} || "
        f"(CASE WHEN text = '' THEN '' ELSE '### Content' || {NL} || {NL} || text END)"
    )
