"""Operators for preparing training corpora: one module per operator, each a
function from DataFrames to DataFrames, plus the registered ``opN_`` queries in
``hirescope.llm.queries``."""
