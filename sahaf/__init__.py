"""Document preparation, vector collections and similarity search on Spark.

All functions take and return DataFrames, so steps compose with ``df.transform``.
"""

from sahaf.functions.html import html_to_markdown
from sahaf.operators.embed import embed_documents, embed_texts, embed_with
from sahaf.operators.graph import graph_summaries
from sahaf.operators.index import add_segment, index_search, publish
from sahaf.operators.ivf import ivf_search, read_ivf, train_centroids, write_ivf
from sahaf.operators.keywords import corpus_keywords, extract_keywords
from sahaf.operators.kmeans import assign_by_tree, centroid_tree, fit_cells, split_cells
from sahaf.operators.lsh import fit_lsh, lsh_search
from sahaf.operators.nearest import recall_at_k, top_k
from sahaf.operators.probing import fit_probing, probe_search, scored_share
from sahaf.operators.search import extract_law_refs, render_hits, search
from sahaf.operators.sentence_ends import learned_sentences
from sahaf.operators.stemming import stem_tokens, stem_words
from sahaf.operators.summarize import summarize, summary_report
from sahaf.operators.terms import tfidf, tfidf_search
from sahaf.operators.token_vectors import cooccurrence, fit_token_vectors, ppmi, token_vectors
from sahaf.session import get_session
from sahaf.sources.collection import append, create_collection, delete_where
from sahaf.sources.files import convert_envelopes, read_envelopes, read_markdown

__all__ = [
    "add_segment",
    "append",
    "assign_by_tree",
    "centroid_tree",
    "convert_envelopes",
    "cooccurrence",
    "corpus_keywords",
    "create_collection",
    "delete_where",
    "embed_documents",
    "embed_texts",
    "embed_with",
    "extract_keywords",
    "extract_law_refs",
    "fit_cells",
    "fit_lsh",
    "fit_probing",
    "fit_token_vectors",
    "get_session",
    "graph_summaries",
    "html_to_markdown",
    "index_search",
    "ivf_search",
    "learned_sentences",
    "lsh_search",
    "ppmi",
    "probe_search",
    "publish",
    "read_envelopes",
    "read_ivf",
    "read_markdown",
    "recall_at_k",
    "render_hits",
    "scored_share",
    "search",
    "split_cells",
    "stem_tokens",
    "stem_words",
    "summarize",
    "summary_report",
    "tfidf",
    "tfidf_search",
    "token_vectors",
    "top_k",
    "train_centroids",
    "write_ivf",
]
