"""Chains of operators: from ballots to the stored network, and from the network to the vertex report."""
