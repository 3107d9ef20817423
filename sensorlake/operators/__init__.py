"""DataFrame transformations: cleaning, statistics, snapshots, serving views."""
