"""The operators as queries over the supplied tables, each beside its SQL check."""
