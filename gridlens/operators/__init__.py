"""DataFrame operators: state snapshots, boxes, similarity, metrics, statistics."""
