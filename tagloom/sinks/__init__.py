"""Where results go: profile tables, index documents, tuple text, bucketed tables."""
