"""Plan helpers: materialisation, size-checked joins, graph components."""
