"""Operations that prepare text collections for training."""
