"""Molecules with their names or with a word of the reason why there is none: fixed values."""

NAMES = {
    "CCO": "ethanol", "CC(C)O": "propan-2-ol", "CCC(=O)C": "butan-2-one", "CC(=O)O": "ethanoic acid", "CC(C)CCC=O": "4-methylpentanal", "C#CC=O": "prop-2-ynal",
    "CC(C)Cl": "2-chloropropane", "CCBr": "bromoethane", "ClC(Cl)(Cl)Cl": "tetrachloromethane", "C": "methane", "CC": "ethane", "CCC": "propane", "CCCC": "butane",
    "C=C": "ethene", "C#C": "ethyne", "C=CC": "prop-1-ene", "CC#CC": "but-2-yne", "CC(C)C": "2-methylpropane", "[NH2]CC(=O)O": "2-aminoethanoic acid",
    "N[C@@H](C)C(=O)O": "(2S)-2-aminopropanoic acid", "C[C@H](O)C(=O)O": "(2S)-2-hydroxypropanoic acid", "C/C=C/C": "(2E)-but-2-ene", "C/C=C\\C": "(2Z)-but-2-ene",
    "O=C(O)[C@H](O)[C@@H](O)C(=O)O": "(2R,3R)-2,3-dihydroxybutanedioic acid", "C[C@H](F)C[C@H](F)C": "(2R,4S)-2,4-difluoropentane",
    "[C@H](F)(Cl)Br": "(S)-bromochlorofluoromethane", "Cl/C=C/Cl": "(E)-1,2-dichloroethene", "c1ccccc1": "benzene", "C1CCCCC1": "cyclohexane", "C1CC1": "cyclopropane",
    "C1CCC1": "cyclobutane", "C1CCCC1": "cyclopentane", "CC1CCCCC1": "methylcyclohexane", "CC1CC(C)CCC1": "1,3-dimethylcyclohexane", "CCC1CCCCC1C": "1-ethyl-2-methylcyclohexane",
    "FC1(F)C(F)(F)C(F)(F)C1(F)F": "octafluorocyclobutane", "CCCCCCC1CCCCC1": "hexylcyclohexane", "CCCCCCC1CCCC1": "hexylcyclopentane", "CCCCCCCCC1CCCC1CCCCCCC": "1-heptyl-2-octylcyclopentane",
    "OC1CCCC1": "cyclopentanol", "O=C1CCCCC1": "cyclohexanone", "NC1CCCCC1": "cyclohexanamine", "OC1C(C)CCCC1": "2-methylcyclohexan-1-ol", "O=C1CCC(C)CC1": "4-methylcyclohexan-1-one",
    "NC1C(C)CCCC1": "2-methylcyclohexan-1-amine", "OC1CC(O)CCC1": "cyclohexane-1,3-diol", "O=C1CC(=O)CCC1": "cyclohexane-1,3-dione", "NC1CC(N)CCC1": "cyclohexane-1,3-diamine",
    "O=C1CC(O)CCC1": "3-hydroxycyclohexan-1-one", "O=C(O)C1CCCCC1": "cyclohexanecarboxylic acid", "NC(=O)C1CC1": "cyclopropanecarboxamide", "N#CC1CCCCC1": "cyclohexanecarbonitrile",
    "O=CC1CCCCC1": "cyclohexanecarbaldehyde", "COC(=O)C1CCCCC1": "methyl cyclohexanecarboxylate", "O=C(Cl)C1CCCCC1": "cyclohexanecarbonyl chloride",
    "O=C(O)C1CCC(=O)CC1": "4-oxocyclohexane-1-carboxylic acid", "N#CC1CCC(=O)C1": "3-oxocyclopentane-1-carbonitrile", "O=C(O)C1CC(C(=O)O)CCC1": "cyclohexane-1,3-dicarboxylic acid",
    "O=C(O)CC1CCCCC1": "cyclohexylacetic acid", "O=C(O)CCC1CCCC1": "3-cyclopentylpropanoic acid", "O=C(O)CCc1ccccc1": "3-phenylpropanoic acid", "CC(O)c1ccccc1": "1-phenylethanol",
    "O=C(O)Cc1ccccc1": "phenylacetic acid", "Cc1ccccc1": "toluene", "Cc1ccccc1C": "1,2-xylene", "Cc1ccc(C)cc1": "1,4-xylene", "CCc1ccccc1": "ethylbenzene", "Clc1ccccc1": "chlorobenzene",
    "COc1ccccc1": "methoxybenzene", "FC(F)(F)c1ccccc1": "(trifluoromethyl)benzene", "CC(C)(C)c1ccccc1": "tert-butylbenzene", "Fc1c(F)c(F)c(F)c(F)c1F": "hexafluorobenzene",
    "Cc1c(C)c(C)c(C)c(C)c1C": "hexamethylbenzene", "Oc1ccccc1": "phenol", "Oc1c(C)cccc1": "2-methylphenol", "Nc1ccccc1": "aniline", "Nc1ccc(Cl)cc1": "4-chloroaniline",
    "Oc1cccc(O)c1": "benzene-1,3-diol", "Oc1c(Cl)c(Cl)c(Cl)c(Cl)c1Cl": "pentachlorophenol", "Oc1c(Cl)c(Cl)c(O)c(Cl)c1Cl": "2,3,5,6-tetrachlorobenzene-1,4-diol",
    "O=C(O)c1ccccc1": "benzoic acid", "O=C(O)c1ccccc1Cl": "2-chlorobenzoic acid", "NC(=O)c1ccccc1": "benzamide", "N#Cc1ccccc1": "benzonitrile", "O=Cc1ccccc1": "benzaldehyde",
    "COC(=O)c1ccccc1": "methyl benzoate", "O=C(Cl)c1ccccc1": "benzoyl chloride", "O=C(O)c1c(F)c(F)c(F)c(F)c1F": "pentafluorobenzoic acid",
    "CCCCC(CC)COC(=O)c1ccccc1C(=O)OCC(CC)CCCC": "bis(2-ethylhexyl) benzene-1,2-dicarboxylate", "O=CCCCCC(=O)O": "6-oxohexanoic acid", "CC(=O)CC(=O)C(=O)O": "2,4-dioxopentanoic acid",
    "CC(N)(CO)CO": "2-amino-2-methylpropane-1,3-diol", "OCC#CCO": "but-2-yne-1,4-diol", "OCC(O)CO": "propane-1,2,3-triol", "OCC(O)C(O)CO": "butane-1,2,3,4-tetrol",
    "O=C(O)CCC(O)C=C(O)C(=O)O": "2,4-dihydroxyhept-2-enedioic acid", "C=C(C)C(=O)O": "2-methylprop-2-enoic acid", "COCC(=O)CO": "1-hydroxy-3-methoxypropan-2-one",
    "ClCCBr": "1-bromo-2-chloroethane", "C=C(CCC(=O)O)C(=O)O": "2-methylidenepentanedioic acid", "C=C(C(=O)O)C(C)C(=O)O": "2-methyl-3-methylidenebutanedioic acid",
    "CC(=O)OCC": "ethyl ethanoate", "CCOC(=O)CCCC(=O)OCC": "diethyl pentanedioate", "CC(O)=CC(=O)OC(C)C": "propan-2-yl 3-hydroxybut-2-enoate", "CCCC(=O)OCC(C)C": "2-methylpropyl butanoate",
    "CCCC(=O)OCCC(C)C": "3-methylbutyl butanoate", "CCCC(=O)OC(C)CC": "butan-2-yl butanoate", "CCCCCCCCCCCCCCCC(=O)OC(C)(C)C": "tert-butyl hexadecanoate",
    "CC(C)C(O)(CC(=O)O)C(=O)O": "2-hydroxy-2-(propan-2-yl)butanedioic acid", "CCCCCCCCCCCCOCCO": "2-(dodecyloxy)ethanol", "CC(=O)COC(C)C": "1-[(propan-2-yl)oxy]propan-2-one",
    "CCCCC(CC)COC(=O)CCCCC(=O)OCC(CC)CCCC": "bis(2-ethylhexyl) hexanedioate", "CCOC(=O)CC(C)=O": "ethyl 3-oxobutanoate", "FC(F)OC(F)C(F)(F)F": "2-(difluoromethoxy)-1,1,1,2-tetrafluoroethane",
    "FC(F)OC(F)(F)C(F)Cl": "2-chloro-1-(difluoromethoxy)-1,1,2-trifluoroethane", "FCOC(C(F)(F)F)C(F)(F)F": "1,1,1,3,3,3-hexafluoro-2-(fluoromethoxy)propane", "CC(=O)C(C)=NO": "3-(hydroxyimino)butan-2-one",
    "CC(=O)NCCCCC(=O)O": "5-(acetylamino)pentanoic acid", "CC(=O)NCCCC(N)CC(=O)O": "6-acetamido-3-aminohexanoic acid", "CC(=O)NCCCC(=O)CC(=O)O": "6-acetamido-3-oxohexanoic acid",
    "CCC(N)=O": "propanamide", "NC(=O)CC(N)=O": "propanediamide", "NC(=O)CCCC(=O)O": "5-amino-5-oxopentanoic acid", "CCCC#N": "butanenitrile", "N#CCC#N": "propanedinitrile",
    "CCC(=O)Cl": "propanoyl chloride", "FC(F)(F)C(F)(F)F": "hexafluoroethane", "CCCCCCCCCCCCCCCCCCCC": "icosane", "C1=CC=CC=C1": "benzene",
}

REASONS = {
    "C1=CCCCC1": "Unsaturated ring", "CC.O": "Disconnected", "[NH3+]CC(=O)[O-]": "Formal-charge", "[13CH3]CO": "Isotopic", "C[C@H](F)[C@H](Cl)Br |&1:1,3|": "Enhanced",
    "O1CCCCC1": "Heterocycle", "C1CCC2CCCCC2C1": "Polycyclic", "O=C(O)CC1CCCCC1C": "Substituted cycloalkyl", "NCC[C@@H](O)[C@@H](C(=O)O)N1CCC1=O": "Heterocyclic",
    "O=C(O)CCCOCC1CCCCC1": "Nested", "O=C(O)CCc1ccccc1C": "Substituted cycloalkyl", "O=C(O)CCc1ccc2ccccc2c1": "Polycyclic", "c1ccccc#1": "Invalid", "O=Ic1ccccc1C(=O)O": "Functionalized halogen",
    "CC(=O)NN": "N-substituted amide", "N=C(N)NC(=N)N": "guanidine", "O=C(O)CN(CCN(CC(=O)O)CC(=O)O)CC(=O)O": "Complex amine", "": "Empty", "C1CC": "Invalid", "C(": "Invalid",
    "[CH3]": "Radical", "CC[Si]": "Unsupported element", "C=O": "carbonyl group",
}
