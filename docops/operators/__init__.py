"""DataFrame operators over documents, change logs, catalogues and alias tables."""
