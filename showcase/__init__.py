"""The library's operators run on the benchmark tables, each with an equivalent SQL text."""
