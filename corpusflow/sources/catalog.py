"""Provider catalogs (A14, E4) as small literal DataFrames.

Fixed values: model names and dimensions, provider names and the fields each
provider config requires. These must equal the reference's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Embedding models (provider, model, dimension).
EMBEDDING_MODELS = [
    ("openai", "text-embedding-3-small", 1536),
    ("openai", "text-embedding-3-large", 3072),
    ("openai", "text-embedding-ada-002", 1536),
    ("cohere", "embed-english-v3.0", 1024),
    ("cohere", "embed-multilingual-v3.0", 1024),
    ("cohere", "embed-english-light-v3.0", 384),
    ("gemini", "gemini-embedding-001", 3072),
    ("gemini", "text-embedding-004", 768),
    ("mistral", "mistral-embed", 1024),
    ("voyage", "voyage-3", 1024),
    ("voyage", "voyage-3-lite", 512),
    ("voyage", "voyage-code-3", 1024),
    ("voyage", "voyage-finance-2", 1024),
    ("voyage", "voyage-law-2", 1024),
]


def _spark() -> SparkSession:
    s = SparkSession.getActiveSession()
    if s is None:
        raise RuntimeError("no active SparkSession")
    return s


def embedding_models() -> DataFrame:
    return _spark().createDataFrame(EMBEDDING_MODELS, "provider string, model string, dimension int")

# Embedding providers (name, label, requires_api_key, local).
EMBEDDING_PROVIDERS = [
    ("openai", "OpenAI", True, False),
    ("cohere", "Cohere", True, False),
    ("gemini", "Google Gemini", True, False),
    ("mistral", "Mistral", True, False),
    ("voyage", "Voyage AI", True, False),
    ("ollama", "Ollama (Local)", False, True),
]

# Vector database providers (name, label, required, optional, local).
VECTOR_DB_PROVIDERS = [
    ("pinecone", "Pinecone", ["api_key", "index_host"], ["namespace"], False),
    ("qdrant", "Qdrant", ["url", "collection_name"], ["api_key"], False),
    ("chroma", "ChromaDB (Local)", ["collection_name"], ["host", "port"], True),
    ("supabase", "Supabase (pgvector)", ["connection_string", "table_name"], ["vector_column"], False),
    ("weaviate", "Weaviate", ["url", "class_name"], ["api_key"], False),
    ("mongodb", "MongoDB Atlas", ["connection_string", "database_name", "collection_name"], ["index_name"], False),
    ("azure_cosmos", "Azure Cosmos DB (NoSQL)", ["connection_string", "database_name", "container_name"], [], False),
    ("azure_cosmos_mongo", "Azure Cosmos DB (MongoDB API)", ["connection_string", "database_name", "collection_name"], ["index_name"], False),
    ("lancedb", "LanceDB (Local)", ["db_path", "table_name"], [], True),
]

# LLM providers (name, label, requires_api_key).
LLM_PROVIDERS = [
    ("openai", "OpenAI", True),
    ("anthropic", "Anthropic", True),
    ("gemini", "Google Gemini", True),
]


def provider_catalog() -> dict[str, DataFrame]:
    """The three provider tables."""
    s = _spark()
    return {
        "embedding": s.createDataFrame(EMBEDDING_PROVIDERS, "provider string, label string, requires_api_key boolean, local boolean"),
        "vector_db": s.createDataFrame(
            VECTOR_DB_PROVIDERS,
            "provider string, label string, required_fields array<string>, optional_fields array<string>, local boolean",
        ),
        "llm": s.createDataFrame(LLM_PROVIDERS, "provider string, label string, requires_api_key boolean"),
    }


def missing_fields(configs: DataFrame, name: str = "name", provider: str = "provider", config: str = "config") -> DataFrame:
    """Required fields a vector-DB config lacks; an empty value counts as
    missing. Unknown providers get one row with a null field. Both joins are
    against the fixed 9-row catalog, which is broadcast."""
    cat = F.broadcast(provider_catalog()["vector_db"].select("provider", "required_fields"))
    need = configs.select(name, provider, config).join(cat, provider, "left")
    req = need.select(name, provider, F.explode_outer("required_fields").alias("field"), config)
    have = F.coalesce(F.trim(F.element_at(F.col(config), F.col("field"))), F.lit("")) != F.lit("")
    return req.where(F.col("field").isNull() | ~have).select(name, provider, "field")
