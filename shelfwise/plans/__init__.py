"""The published tables and documents, composed from the operators."""
