"""Relational and MLlib operators: features, indexing, clustering, detection."""
