"""Fixed table schemas. They are always given to the reader, so a partition value
such as ``source=007`` stays a string."""

PARTITION_KEYS = ["year", "source"]

RECORD = "ia_id STRING, text STRING, source_uri STRING"

METADATA = "ia_id STRING, year INT, title STRING, author STRING"

DOCUMENTS = (
    "doc_id STRING, source STRING, year INT, title STRING, author STRING, text_uri STRING, "
    "text_bytes BIGINT, text_checksum STRING, preview STRING, ingest_run_id STRING, "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)

BLOBS = "checksum STRING, text STRING, n_bytes BIGINT"

CHUNKS = (
    "chunk_id STRING, doc_id STRING, year INT, source STRING, seq INT, start_token INT, "
    "end_token INT, text STRING, text_checksum STRING, token_count INT, ingest_run_id STRING, "
    "created_at TIMESTAMP, tokens ARRAY<INT>"
)

EMBEDDINGS = (
    "chunk_id STRING, doc_id STRING, year INT, source STRING, model STRING, "
    "vector ARRAY<FLOAT>, dim INT, created_at TIMESTAMP"
)

VECTOR_META = "faiss_id BIGINT, chunk_id STRING, doc_id STRING, year INT, source STRING"

SEARCH_DOCUMENT = "chunk_id STRING, doc_id STRING, year BIGINT, source STRING, text STRING"

COARSE_CENTROIDS = "list_id INT, vector ARRAY<FLOAT>"

PQ_CODEBOOKS = "sub INT, code INT, vector ARRAY<FLOAT>"

IVF_POSTINGS = (
    "list_id INT, faiss_id BIGINT, chunk_id STRING, year INT, source STRING, codes BINARY, "
    "list_band INT"
)

TEXT_POSTINGS = (
    "term STRING, chunk_id STRING, doc_id STRING, year BIGINT, source STRING, tf INT, "
    "positions ARRAY<INT>, doc_len INT, place STRING"
)

TEXT_TERMS = "term STRING, df BIGINT"

# Rows of kind "chunks" (number to place) and of kind "terms" (term to positions) of each segment, or block.
TEXT_SEGMENTS = (
    "block BIGINT, term STRING, n INT, steps BINARY, tf BINARY, positions BINARY, number INT, chunk_id STRING, doc_id STRING, "
    "year BIGINT, source STRING, doc_len INT, place STRING, kind STRING"
)

# A term of a segment: its n postings as steps from chunk to chunk, frequencies, and the positions of all of them.
TEXT_LISTS = "term STRING, block BIGINT, n INT, steps BINARY, tf BINARY, positions BINARY"

# The parts of a file's terms are null where the index was written without parts.
TEXT_FILES = "file STRING, first_term STRING, last_term STRING, first_place BIGINT, last_place BIGINT, first_part INT, last_part INT"

TEXT_DOCS = "chunk_id STRING, doc_id STRING, year BIGINT, source STRING, doc_len INT"

# Whether a chunk's stored fields may come twice; null where the index was written without asking.
TEXT_CORPUS = "n DOUBLE, avg_len DOUBLE, digits INT, copies BOOLEAN"


def columns(ddl: str) -> list[str]:
    """Column names of one of the schemas above, in order."""
    return [field.split()[0] for field in ddl.split(", ")]
