"""The layers: silver, gold, marts, reports, quality checks, and the run over all of them."""
