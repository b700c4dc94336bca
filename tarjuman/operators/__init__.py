"""DataFrame operators: cells, requests, rounds, progress, statistics, rates."""
