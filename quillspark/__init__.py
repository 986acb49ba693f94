"""quillspark: a PySpark engine that builds, curates and queries literature corpora."""

__version__ = "0.1.0"
