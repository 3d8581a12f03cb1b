"""Readers: feeds, shards, pages, rulings, prose, grids and registries."""
