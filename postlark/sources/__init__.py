"""Reading and writing: corpora, message streams, search results, tables and stores."""
