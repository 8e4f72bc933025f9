"""The four flows as lazy DataFrame graphs: prepare, score by prompt, train and score, compare."""
