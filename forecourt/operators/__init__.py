"""DataFrame operators: frames in, frame out, nothing is collected."""
