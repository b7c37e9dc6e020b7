"""Report programs: frames and parameters in, one lazy DataFrame out."""
