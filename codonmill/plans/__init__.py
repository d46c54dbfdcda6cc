"""The jobs: raw table in, processed tables out; and the queries across them."""
