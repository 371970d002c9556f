"""Training-data operators: text corpora in, decisions per document out.

One module per operator; ``queries`` registers the thin contract queries and ``oracle`` their
DuckDB SQL where SQL can express them.  Nothing outside this subpackage imports it.
"""
