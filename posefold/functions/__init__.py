"""Column-level building blocks: classification, kinematics, rotations, masks and text."""
