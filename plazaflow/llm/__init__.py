"""Operations of a training-data pipeline over tables of documents and conversations.

Every operator takes a DataFrame and the names of its key and text columns, reads only these, and
returns a DataFrame. Columns of the input that an operator does not read never reach it, so their
names cannot clash with those it makes. The thin queries are in `queries`, their SQL in `oracles`.
"""
