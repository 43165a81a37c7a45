"""SQL fragments shared by the DuckDB oracles."""

from textloom.functions.text import WORD_PATTERN

NL = "chr(10)"
DOCS = ("(SELECT *, CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split "
        "FROM documents)")
TRIM = "trim(text, ' ' || chr(10))"
WP = WORD_PATTERN

# word-level vocabulary trained on the train split, and every document's ids
WORD_IDS = f"""
d AS {DOCS},
wc AS (SELECT word, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(text, '{WP}')) AS word
       FROM d WHERE split = 'train') GROUP BY word),
v AS (SELECT word, CAST(row_number() OVER (ORDER BY freq DESC, word) - 1 + 5 AS INTEGER) AS id FROM wc),
occ AS (SELECT doc_id, split, w, unnest(range(len(w))) AS i
        FROM (SELECT doc_id, split, regexp_extract_all(text, '{WP}') AS w FROM d)),
tok AS (SELECT o.doc_id, o.split, o.i, o.word, coalesce(v.id, 0) AS id
        FROM (SELECT doc_id, split, i, w[i + 1] AS word FROM occ) o LEFT JOIN v USING (word)),
ids AS (SELECT doc_id, split, list(id ORDER BY i) AS ids FROM tok GROUP BY doc_id, split)"""


def ids_str(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"


# only the word-level vocabulary v(word, id)
WORD_VOCAB = f"""
d AS {DOCS},
wc AS (SELECT word, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(text, '{WP}')) AS word
       FROM d WHERE split = 'train') GROUP BY word),
v AS (SELECT word, CAST(row_number() OVER (ORDER BY freq DESC, word) - 1 + 5 AS INTEGER) AS id FROM wc)"""


def ids_of(name: str, src: str, text_col: str, keys: str) -> str:
    """CTE ``name(keys..., ids)``: word-level ids of ``text_col`` in ``src``."""
    return f"""
{name}_w AS (SELECT {keys}, regexp_extract_all({text_col}, '{WP}') AS w FROM {src}),
{name}_e AS (SELECT {keys}, w, unnest(range(len(w))) AS i FROM {name}_w),
{name}_t AS (SELECT e.*, coalesce(v.id, 0) AS id FROM (SELECT {keys}, i, w[i + 1] AS word
             FROM {name}_e) e LEFT JOIN v USING (word)),
{name} AS (SELECT {keys}, list(id ORDER BY i) AS ids FROM {name}_t GROUP BY {keys})"""
