"""Training-data operators: ten numbered operators over documents, embeddings
and conversations. Nothing outside this package imports it; its queries are
in ``registry``."""
